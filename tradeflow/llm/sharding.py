"""Sharding by rendezvous hashing: a record goes to the shard that scores it highest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import fresh

# Slots are counted in this many pieces of a shard, each sorted by one task.
PIECES = 1024


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key, from 0 to len(weights) - 1.

    Shard ``s`` scores ``-weight / ln(u)`` with ``u`` in (0, 1) drawn by a hash of
    (s, key); the highest score wins, the smaller shard on a tie. A shard gets a
    part of the keys in proportion to its weight, and scores of different shards
    do not touch each other: a new shard only takes keys, a dropped one only
    gives up its own. Weights must be positive. Null is a key like any other.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("one positive weight per shard is needed")
    key = F.coalesce(key.cast("string"), F.lit("\x00null"))
    if len(set(weights)) == 1:  # the logarithm keeps the order: compare plain hashes
        scores = F.transform(
            F.sequence(F.lit(0), F.lit(len(weights) - 1)),
            lambda s: F.struct((-F.shiftright(F.xxhash64(s, key), 1)).alias("score"), s.alias("s")),
        )
        return F.array_min(scores)["s"]
    scores = F.transform(
        F.arrays_zip(
            F.sequence(F.lit(0), F.lit(len(weights) - 1)).alias("s"),
            F.array(*[F.lit(float(w)) for w in weights]).alias("w"),
        ),
        lambda x: F.struct(
            (
                -F.log((F.shiftrightunsigned(F.xxhash64(x["s"], key), 11) + 0.5) / float(2**53))
                / x["w"]
            ).alias("score"),
            x["s"].alias("s"),
        ),
    )
    return F.array_min(scores)["s"]


def shard_records(
    df: DataFrame, key_column: str, weights: Sequence[float], new_weight: float | None = None
) -> DataFrame:
    """``df`` with its ``shard``, and ``grown_shard`` once a shard of ``new_weight`` joins.

    Needs no shuffle: the key and the weights decide alone. Rows of one key share
    a shard. Columns of ``df`` with these names are replaced.
    """
    key = F.col(key_column)
    added = {"shard": rendezvous_shard(key, weights).cast("int")}
    if new_weight is not None:
        grown = rendezvous_shard(key, [*weights, new_weight])
        added["grown_shard"] = grown.cast("int")
    return df.withColumns(added)


def number_slots(df: DataFrame, order: Sequence[str], pieces: int = PIECES) -> DataFrame:
    """``df`` (with ``shard``) with ``slot``, gapless from 0 in every shard.

    The columns of ``df`` must be short: equal rows are counted before the first
    shuffle and written out again at the end, so a row repeated very often is no
    hot key. Each shard is cut into ``pieces`` by a hash of ``order``; a piece is
    numbered by itself and starts where the rows of the pieces before it end.
    Rows that agree in ``order`` take neighbouring slots, by their other columns.
    """
    piece, copies, start, first = fresh(df, "piece", "copies", "start", "first")
    counted = (
        df.withColumn(piece, F.pmod(F.xxhash64(*order), F.lit(pieces)).cast("int"))
        .groupBy(*df.columns, piece)
        .agg(F.count(F.lit(1)).alias(copies))
    )
    before = Window.partitionBy("shard").orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.groupBy("shard", piece)
        .agg(F.sum(copies).alias(first))
        .withColumn(start, F.coalesce(F.sum(first).over(before), F.lit(0)))
        .drop(first)
    )
    inside = (
        Window.partitionBy("shard", piece)
        .orderBy(*order, *[c for c in df.columns if c not in (*order, "shard")])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        counted.withColumn(first, F.coalesce(F.sum(copies).over(inside), F.lit(0)))
        .join(starts, ["shard", piece])
        .withColumn(first, F.col(first) + F.col(start))
        .select(
            *df.columns,
            F.explode(F.sequence(first, F.col(first) + F.col(copies) - 1)).alias("slot"),
        )
    )
