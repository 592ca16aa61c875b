"""Tumbling windows over silver: bars, five-second windows and bar features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BAR = "5 minutes"
BURST = "5 seconds"
BAR_SEC = 300
BURST_SEC = 5

BAR_COLUMNS = [
    "window_start", "window_end", "symbol", "open_price", "high", "low", "close_price",
    "volume", "trade_count", "buy_volume", "sell_volume",
]


# Where a trade stands among those of its window, as one number: time of day, then
# trade id, then a hash of the rest, so that trades of one id have one order too. The
# time is computed, so that in a stream it carries no second watermark mark.
_TIE = f"(hash(price, quantity) & {(1 << 24) - 1})"
_TIME = "timestamp_micros(unix_micros(event_time))"
_PLACE = f"""(CAST(pmod(unix_micros(event_time), 86400000000) AS DECIMAL(38, 0)) * {1 << 88}BD
    + CAST(coalesce(trade_id, {-(2**63) + 1} - 1) AS DECIMAL(38, 0)) * {1 << 24}BD
    + {_TIE})"""


def summarise(silver: DataFrame, length: str) -> DataFrame:
    """One row per non-empty (window, symbol), batch or stream.

    Windows must divide a day. ``first_*`` and ``last_*`` are of the extreme trades by
    (event time, trade id). They come out of the same aggregate as the sums, so the
    trades are shuffled once, already combined on the map side; the order of two trades
    is that of one number (``first_place``, ``last_place``), which a hash aggregate keeps
    in its buffer, so trades are never sorted. A trade without a maker flag counts on
    neither side. Columns nobody reads are pruned.
    """
    placed = silver.withColumn("place", F.expr(_PLACE))
    summary = placed.groupBy(F.window("event_time", length).alias("window"), "symbol").agg(
        F.expr("min(price) AS low"),
        F.expr("max(price) AS high"),
        F.expr("sum(quantity) AS volume"),
        F.expr("count(*) AS trade_count"),
        F.expr("sum(IF(NOT is_maker, quantity, 0D)) AS buy_volume"),
        F.expr("sum(IF(is_maker, quantity, 0D)) AS sell_volume"),
        F.expr("min(place) AS first_place"),
        F.expr(f"min({_TIME}) AS first_time"),
        F.expr("min_by(trade_id, place) AS first_id"),
        F.expr("min_by(price, place) AS first_price"),
        F.expr("min_by(quantity, place) AS first_quantity"),
        F.expr("max(place) AS last_place"),
        F.expr(f"max({_TIME}) AS last_time"),
        F.expr("max_by(price, place) AS last_price"),
    )
    return summary.selectExpr(
        "window.start AS window_start", "window.end AS window_end", "* EXCEPT (window)"
    )


def with_open_close(summary: DataFrame) -> DataFrame:
    return summary.selectExpr("*", "first_price AS open_price", "last_price AS close_price")


def bars(silver: DataFrame, length: str = BAR) -> DataFrame:
    return with_open_close(summarise(silver, length)).select(BAR_COLUMNS)


def bursts(silver: DataFrame, length: str = BURST) -> DataFrame:
    return summarise(silver, length).select(
        "window_start", "window_end", "symbol", "trade_count", "volume"
    )


def price_features(bars: DataFrame) -> DataFrame:
    return bars.selectExpr(
        "*",
        "(close_price - open_price) / nullif(open_price, 0D) * 100D AS pct_change",
        "(high - low) / nullif(open_price, 0D) * 100D AS range_pct",
    )


def with_avg_volume(bars: DataFrame, windows: int = 20) -> DataFrame:
    """Mean volume of the last ``windows`` bars of the symbol, this one included.

    Batch only. A symbol has at most one bar per five minutes, about 105,000 a
    year however many trades it has, so one task per symbol stays small.
    """
    trailing = (
        Window.partitionBy("symbol").orderBy("window_start").rowsBetween(1 - windows, 0)
    )
    return bars.withColumn("avg_vol_20", F.avg("volume").over(trailing))


def bar_features(bars: DataFrame, windows: int = 20) -> DataFrame:
    return with_avg_volume(price_features(bars), windows)


def window_features(silver: DataFrame, windows: int = 20) -> DataFrame:
    """Bars with features and five-second windows, from one pass over the trades.

    Trades are combined into five-second windows first; those are rolled up into
    bars and kept, in one second aggregate (``burst_start`` is NULL on a bar).
    ``previous_time`` is the last trade before the row's first one: on a bar the
    last of the symbol's previous bar, on a five-second window the last of the
    previous window *of the same bar*. The first window of a bar has none; its
    bar has it. So no ordered group grows with the number of trades: a bar holds
    at most 60 windows, and a symbol one bar per five minutes.
    """
    grains = summarise(silver, BURST).select(
        "*",
        F.window("window_start", BAR)["start"].alias("bar_start"),
        F.expr("explode(array(NULL, window_start)) AS burst_start"),
    )
    rolled = grains.groupBy("symbol", "bar_start", "burst_start").agg(
        F.expr("min(low) AS low"),
        F.expr("max(high) AS high"),
        F.expr("sum(volume) AS volume"),
        F.expr("sum(trade_count) AS trade_count"),
        F.expr("sum(buy_volume) AS buy_volume"),
        F.expr("sum(sell_volume) AS sell_volume"),
        F.expr("min(first_time) AS first_time"),
        F.expr("min_by(first_id, first_place) AS first_id"),
        F.expr("min_by(first_price, first_place) AS first_price"),
        F.expr("min_by(first_quantity, first_place) AS first_quantity"),
        F.expr("max(last_time) AS last_time"),
        F.expr("max_by(last_price, last_place) AS last_price"),
    )
    timed = with_open_close(rolled).selectExpr(
        "*",
        "coalesce(burst_start, bar_start) AS window_start",
        f"bar_start + INTERVAL {BAR_SEC} SECONDS AS bar_end",
        f"burst_start + INTERVAL {BURST_SEC} SECONDS AS burst_end",
        "IF(burst_start IS NULL, NULL, bar_start) AS within",
    )
    order = "PARTITION BY symbol, within ORDER BY window_start"
    return price_features(timed).selectExpr(
        "*",
        "coalesce(burst_end, bar_end) AS window_end",
        f"avg(volume) OVER ({order} ROWS {windows - 1} PRECEDING) AS avg_vol_20",
        f"lag(last_time) OVER ({order}) AS previous_time",
    )


# ---- Twins: the same results by rank and join. Batch only, for cross-checks. ----


def windowed(silver: DataFrame, length: str = BAR) -> DataFrame:
    """Trades with the bounds of their window."""
    return (
        silver.withColumn("window", F.window("event_time", length))
        .withColumn("window_start", F.col("window.start"))
        .withColumn("window_end", F.col("window.end"))
        .drop("window")
    )


def extreme_by_rank(silver: DataFrame, name: str, *, last: bool = False) -> DataFrame:
    """First or last price of each bar by ``row_number() = 1``.

    Spark limits each group to one row before the shuffle, so a hot group sends
    one row per map task.
    """
    order = [F.col("event_time"), F.col("trade_id"), F.expr(_TIE)]
    group = Window.partitionBy("window_start", "window_end", "symbol").orderBy(
        *(c.desc() if last else c.asc() for c in order)
    )
    return (
        windowed(silver)
        .withColumn("rn", F.row_number().over(group))
        .where("rn = 1")
        .select("window_start", "window_end", "symbol", F.col("price").alias(name))
    )


def bars_by_join(silver: DataFrame) -> DataFrame:
    """Bars as statistics joined with ranked open and close prices."""
    keys = ["window_start", "window_end", "symbol"]
    stats = summarise(silver, BAR)
    return (
        stats.join(extreme_by_rank(silver, "open_price"), keys, "inner")
        .join(extreme_by_rank(silver, "close_price", last=True), keys, "inner")
        .select(BAR_COLUMNS)
    )
