"""Bring rows that belong in one file together, without one task per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def turn(pieces: Column) -> Column:
    """Deals the rows of a task to pieces in turn; the first row's piece differs by task.

    Unlike a hash of the row this splits copies of one row, and unlike a hash of the
    task it splits the rows of one task evenly.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return F.pmod(place + F.spark_partition_id(), pieces)


def same_keys(a: Sequence[str], b: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b, strict=True)))


def deal(df: DataFrame, keys: Sequence[str], sizes: DataFrame, per_task: int) -> DataFrame:
    """Shuffle ``df`` so that each task gets about ``per_task`` of ``size``, keys in order.

    ``sizes`` holds the ``size`` of each key, in rows or bytes. Keys are laid end to end
    and cut into tasks of that size: small keys share a task, a hot one has as many as
    it needs. One task orders the keys, not the rows.
    """
    names = [f"key_{i}" for i in range(len(keys))]
    order = Window.orderBy(*names)
    laid = sizes.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), "size")
    before = F.sum("size").over(order) - F.col("size")
    laid = laid.withColumn("first_task", F.floor(before / per_task)).withColumn(
        "tasks", F.floor((before + F.greatest("size", F.lit(1)) - 1) / per_task) + 1 - F.col("first_task")
    )
    tasks = laid.agg(F.max(F.col("first_task") + F.col("tasks"))).first()[0] or 1
    placed = df.join(laid.drop("size"), same_keys(keys, names), "left")
    task = F.coalesce(F.col("first_task") + turn(F.col("tasks")), F.lit(0))
    placed = placed.withColumn("task", task.cast("int"))
    return placed.repartitionById(int(tasks), F.col("task")).select(df.columns)


def spread(df: DataFrame, keys: Sequence[str], rows_per_task: int | None = None) -> DataFrame:
    """Shuffle by ``keys`` so that a hot key is split.

    Without ``rows_per_task`` adaptive execution does it: it splits large keys and
    merges small ones to the advisory size, in one pass. Streams run without it; they
    count the rows of each key of their batch first, which should be kept for that.
    """
    if rows_per_task is None:
        return df.hint("rebalance", *keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    return deal(df, keys, sizes, rows_per_task)
