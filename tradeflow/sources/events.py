"""Trades read out of the ``events`` table.

The test tables hold no trades, so every query maps ``events`` to the wire shape
first. Odd days are squeezed by 20,000 into the seconds after midnight, which
gives windows dense enough for bars and bursts; even days keep real time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.functions.columns import stream_name
from tradeflow.sources.trades import envelope_text, message_text

DAY_MS = 86_400_000
SQUEEZE = 20_000

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A glob, because a stream wants a folder and the table may be one file.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")


def trades_from_events(events: DataFrame) -> DataFrame:
    """Raw trades in the internal column names, plus ``event_time``.

    Some users' trades lack a symbol or a price, so that the quality rules have
    work.
    """
    day, time_of_day = f"ms div {DAY_MS}", f"pmod(ms, {DAY_MS})"
    return (
        events.selectExpr("*", "unix_millis(CAST(ts AS timestamp)) AS ms")
        .selectExpr(
            "*",
            f"""ms - {time_of_day} + IF(({day}) % 2 = 1, {time_of_day} div {SQUEEZE}, {time_of_day})
                AS event_ms""",
        )
        .selectExpr(
            "'trade' AS event_kind",
            "event_ms",
            "IF(user_id = 1, NULL, upper(event_type)) AS symbol",
            "event_id AS trade_id",
            "IF(user_id = 0, NULL, CAST(100 + value / 20 AS string)) AS price",
            "get_json_object(props, '$.k') AS qty",
            "event_ms - event_id % 50 AS trade_ms",
            "user_id % 2 = 0 AS is_maker",
            "true AS ignore_flag",
            "timestamp_millis(event_ms) AS event_time",
        )
    )


def envelopes_from_trades(trades: DataFrame) -> DataFrame:
    """Every trade as an envelope message, damaged for a few quantities."""
    message = envelope_text()
    stream = F.to_json(F.struct(stream_name().alias("stream")), {"ignoreNullFields": "false"})
    value = (
        F.when(F.col("qty") == "1", F.substring(message, F.lit(1), F.length(message) - 1))
        .when(F.col("qty") == "2", stream)
        .when(F.col("qty") == "3", F.regexp_replace(stream, r"\}$", ',"data":{}}'))
        .when(F.col("qty") == "4", F.regexp_replace(message, r"\}\}$", ',"x":{"y":[1]}}}'))
        .otherwise(message)
    )
    return trades.select(value.alias("value"))


def messages_from_trades(trades: DataFrame) -> DataFrame:
    """Every trade as a bare message, cut short for one quantity."""
    text = message_text()
    cut = F.when(F.col("qty") == "1", F.substring(text, F.lit(1), F.length(text) - 1))
    return trades.select(cut.otherwise(text).alias("value"))


def symbol_lines_from_events(events: DataFrame) -> DataFrame:
    """(shard, line_no, line): the traded symbols as two untidy symbol lists.

    A symbol's line number is its first event.
    """
    return events.groupBy("event_type").agg(F.min("event_id").alias("line_no")).select(
        F.when(F.col("event_type") < "m", 1).otherwise(2).alias("shard"),
        "line_no",
        F.concat(F.lit("  "), F.initcap("event_type"), F.lit("\t ")).alias("line"),
    )
