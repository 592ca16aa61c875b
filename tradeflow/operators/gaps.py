"""Time between consecutive trades of a symbol, in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trade_gaps(silver: DataFrame, slice_length: str = "1 minute") -> DataFrame:
    """Every trade with the time of the symbol's previous trade, by (time, trade id).

    The lag runs over the trades of a slice of the symbol, and over the slices:
    the first trade of a slice follows the last time of the slice before. So no
    task orders the whole history of a symbol. Slices are combined before their
    shuffle; a symbol has one per minute in which it traded.
    """
    timed = silver.where("event_time IS NOT NULL").withColumn(
        "slice_start", F.window("event_time", slice_length)["start"]
    )
    slices = (
        timed.groupBy("symbol", "slice_start")
        .agg(F.max("event_time").alias("last_time"))
        .selectExpr(
            "symbol AS of_symbol",
            "slice_start AS of_slice",
            "lag(last_time) OVER (PARTITION BY symbol ORDER BY slice_start) AS before_slice",
        )
    )
    inside = Window.partitionBy("symbol", "slice_start").orderBy("event_time", "trade_id")
    lagged = timed.withColumn("inside", F.lag("event_time").over(inside)).join(
        slices, F.expr("symbol <=> of_symbol AND slice_start = of_slice")
    )
    return lagged.withColumn("previous_time", F.coalesce("inside", "before_slice")).selectExpr(
        "symbol",
        "event_time",
        "trade_id",
        "price",
        "quantity",
        "previous_time",
        "(unix_seconds(event_time) - unix_seconds(previous_time)) * 1000 AS gap_ms",
    )
