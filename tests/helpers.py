"""Hand-written trades."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tradeflow.schema import TRADE

# A whole five minutes.
BASE_MS = 1_704_103_200_000  # 2024-01-01 10:00:00 UTC


def trade(ms, price="100", qty="1", symbol="AAA", trade_id=None, is_maker=False):
    event_ms = None if ms is None else BASE_MS + ms
    trade_id = ms if trade_id is None else trade_id
    return ("trade", event_ms, symbol, trade_id, price, qty, event_ms, is_maker, True)


def trades(spark, rows):
    raw = spark.createDataFrame(rows, TRADE)
    return raw.withColumn("event_time", F.timestamp_millis("event_ms"))


def message(row):
    return json.dumps(dict(zip("eEstpqTmM", row, strict=True)))


def at(ms):
    """The naive UTC time of an offset."""
    return dt.datetime(2024, 1, 1, 10) + dt.timedelta(milliseconds=ms)


def same_rows(a, b):
    """Both frames hold the same multiset of rows."""
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
