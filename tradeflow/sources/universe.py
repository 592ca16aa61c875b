"""The symbols a feed subscribes to."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.functions.columns import stream_name

# Fixed value: most streams that one subscription carries.
SHARD_SIZE = 1000


def universe_from_lines(
    lines: DataFrame, shard_size: int = SHARD_SIZE, shards: int = 1
) -> DataFrame:
    """(shard, line_no, line) to (shard, line_no, symbol), with every symbol kept.

    Lines are trimmed and lower-cased, blank ones dropped. A list of more than
    ``shard_size`` symbols goes on in further shards: the ``k``-th part of list
    ``s`` is shard ``s + k * shards``, where ``shards`` is the number of lists.
    """
    symbols = lines.select(
        "shard",
        "line_no",
        F.lower(F.regexp_replace("line", r"(?U)^\s+|\s+$", "")).alias("symbol"),
    ).where("symbol <> ''")
    in_order = Window.partitionBy("shard").orderBy("line_no")
    part = F.floor((F.row_number().over(in_order) - 1) / shard_size).cast("int")
    return symbols.withColumn("part", part).select(
        (F.col("shard") + F.col("part") * shards).alias("shard"), "line_no", "symbol"
    )


def load_universe(
    spark: SparkSession, paths: Sequence[str], shard_size: int = SHARD_SIZE
) -> DataFrame:
    """Read symbol files, one or more shards each; an empty list is an error."""
    lists = []
    for number, path in enumerate(paths, start=1):
        # A symbol list is one small file, so its lines keep their order.
        whole = spark.read.text(path, wholetext=True)
        lines = whole.select(
            F.lit(number).alias("shard"),
            F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("line_no", "line"),
        )
        symbols = universe_from_lines(lines, shard_size, len(paths))
        if symbols.isEmpty():
            raise ValueError(f"no symbol in {path}")
        lists.append(symbols)
    if not lists:
        raise ValueError("no symbol file given")
    return reduce(DataFrame.unionByName, lists)


def stream_list(universe: DataFrame) -> DataFrame:
    """The subscription of each shard: its stream names joined with ``/``."""
    names = F.array_sort(F.collect_list(F.struct("line_no", stream_name().alias("name"))))
    return universe.groupBy("shard").agg(
        F.array_join(F.transform(names, lambda n: n["name"]), "/").alias("streams")
    )


def restrict_to_universe(trades: DataFrame, universe: DataFrame) -> DataFrame:
    """Trades of subscribed symbols, with their stream name.

    There is no broadcast hint: Spark broadcasts the list when its size is below
    the session's threshold.
    """
    wanted = universe.select(F.col("symbol").alias("wanted"))
    kept = trades.join(wanted, F.lower("symbol") == F.col("wanted"), "left_semi")
    return kept.withColumn("stream", stream_name())


def feed_by_shard(trades: DataFrame, universe: DataFrame) -> DataFrame:
    """The union of all shards' feeds, read in one pass.

    A symbol on two lists arrives once per list, as from two feeds.
    """
    wanted = universe.select("shard", F.col("symbol").alias("wanted")).distinct()
    return (
        trades.join(wanted, F.lower("symbol") == F.col("wanted"), "inner")
        .drop("wanted")
        .withColumn("stream", stream_name())
    )
