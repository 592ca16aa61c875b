"""Mixing sources to target weights: Pfair windows, earliest deadline first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import islice
from math import lcm

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import checkpointed, fresh, ship

# Production settings.
BLOCK_ROWS = 16
PIECES = 1024
TEMPERATURE = 0.7
ROWS = 50_000


def whole_weights(weights: Sequence[float]) -> list[int]:
    """The weights as whole numbers in exactly the same proportions."""
    exact = [Fraction(w) for w in weights]
    common = lcm(*(x.denominator for x in exact))
    return [int(x * common) for x in exact]


def pfair_slots(
    blocks: Sequence[int], weights: Sequence[int]
) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, release, deadline, slot) of all blocks, in the order of their slots.

    With ``s`` the total weight of the sources that are left, block ``j`` of a source of
    weight ``w`` may run from slot floor(j s / w) and must run before slot
    ceil((j + 1) s / w), counted from the start of the stretch; the released block with
    the earliest deadline runs first. Such a schedule meets every deadline, so no source
    is ever a whole block ahead of or behind its weight; as all numbers are whole,
    nothing drifts, however long the stretch. It ends when a source runs out; the next
    one shares its part among the others.
    """
    left = {i: n for i, n in enumerate(blocks) if n}
    done = dict.fromkeys(left, 0)
    start = 0
    while left:
        total = sum(weights[i] for i in left)
        ready = [(-(-total // weights[i]), i, 0, 0) for i in left]
        heapq.heapify(ready)
        waiting: list[tuple[int, int, int, int]] = []
        given = dict.fromkeys(left, 0)
        slot = 0
        while True:
            while waiting and waiting[0][0] <= slot:
                release, deadline, i, j = heapq.heappop(waiting)
                heapq.heappush(ready, (deadline, i, j, release))
            deadline, i, j, release = heapq.heappop(ready)
            yield i, done[i] + j, start + release, start + deadline, start + slot
            slot += 1
            j += 1
            given[i] = j
            if j == left[i]:
                break
            following = (j * total // weights[i], -(-(j + 1) * total // weights[i]), i, j)
            heapq.heappush(waiting, following)
        for i, n in given.items():
            done[i] += n
            left[i] -= n
        left = {i: n for i, n in left.items() if n}
        start += slot


def _scheduled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All slots, made in one task that holds a row for each source and hands on slices."""
    held = list(batches)
    if not held:
        return
    sources = pd.concat(held).sort_values("src")
    numbers = sources["src"].tolist()
    weights = whole_weights(sources["weight"].tolist())
    slots = pfair_slots(sources["blocks"].tolist(), weights)
    while rows := list(islice(slots, ROWS)):
        made = pd.DataFrame(rows, columns=["src", "block", "release", "deadline", "slot"])
        yield made.assign(src=made["src"].map(dict(enumerate(numbers))))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    source_column: str = "source",
    id_column: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
    pieces: int = PIECES,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """``docs`` with (mix_block, mix_release, mix_deadline, mix_slot, mix_position).

    Every row stays, once. Each source is put into a hashed order and cut into blocks of
    ``block_rows`` rows. Until a source runs out, the blocks of all are scheduled by
    windows counted from the start, in whole numbers, so no source is ever a whole block
    ahead of or behind its weight; then the others share its part in proportion to their
    weights, counted from there. ``mix_block`` counts the blocks of a source; release,
    deadline and slot count blocks of all sources from the start; ``mix_position`` orders
    the rows.

    ``weights`` names a positive weight for each source; sources without one get the
    smallest. By default a source weighs its number of rows to the power of
    ``temperature``: 1 keeps the corpus's own mix, 0 treats all sources alike.

    A schedule of this kind has a state, so one task makes the slots of all blocks, two
    microseconds each; it holds one row for each source. Only blocks pass it, not rows:
    with a thousand million blocks, raise ``block_rows``. Rows find the slot of their
    block by a join on source and block; nothing passes through the driver. Rows are numbered in hashed pieces of each
    source; a hot source is no hot task. A null source is a source of its own. Rows that
    agree in id and all hashed columns are interchangeable. A result takes a leading
    underscore where ``docs`` has a column of its name. An empty table gives an empty
    result.
    """
    results = fresh(docs, "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_position")
    if weights is not None and min(weights.values(), default=1.0) <= 0:
        raise ValueError("weights must be positive")
    spark = docs.sparkSession
    ship(spark)
    key, piece, n, start, block, rank, tie, src, p_src, p_block, release, deadline, slot = fresh(
        docs, "key", "piece", "n", "start", "block", "rank", "tie", "src", "p_src", "p_block",
        "release", "deadline", "slot",
    )
    others = [c for c in docs.columns if c not in (id_column, source_column)]
    keyed = docs.withColumns(
        {
            key: F.coalesce(F.concat(F.lit("s"), F.col(source_column).cast("string")), F.lit("n")),
            rank: F.xxhash64(id_column),
        }
    )
    keyed = keyed.withColumn(piece, F.pmod(F.shiftright(rank, 20), F.lit(pieces)).cast("int"))
    counts = keyed.groupBy(key, piece).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(key).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(start, F.coalesce(F.sum(n).over(before), F.lit(0))).drop(n)

    sources = counts.groupBy(key).agg(F.sum(n).alias(n))
    if weights is None:
        sources = sources.withColumn("weight", F.pow(F.col(n).cast("double"), F.lit(temperature)))
    else:
        given = [("n" if k is None else f"s{k}", float(w)) for k, w in weights.items()]
        named = spark.createDataFrame(given, f"`{key}` string, weight double")
        least = min(weights.values(), default=1.0)
        sources = sources.join(named, key, "left").fillna({"weight": float(least)})
    # One task numbers the sources; they are few against their rows.
    sources = checkpointed(
        sources.withColumn(src, F.row_number().over(Window.orderBy(key)).cast("long"))
        .withColumn("blocks", F.ceil(F.col(n) / block_rows))
        .select(key, F.col(src), "weight", "blocks")
    )
    placed = (
        sources.select(F.col(src).alias("src"), "weight", "blocks")
        .coalesce(1)
        .mapInPandas(_scheduled, "src long, block long, release long, deadline long, slot long")
        .toDF(p_src, p_block, release, deadline, slot)
    )
    inside = Window.partitionBy(key, piece).orderBy(rank, id_column, tie)
    numbered = (
        keyed.withColumn(tie, F.xxhash64(*others) if others else F.lit(0))
        .withColumn(n, F.row_number().over(inside) - 1)
        .join(starts, [key, piece])
        .withColumn(n, F.col(n) + F.col(start))
        .join(sources.select(key, src), key)
        .withColumn(block, F.floor(F.col(n) / block_rows))
    )
    mixed = numbered.join(
        placed, (F.col(src) == F.col(p_src)) & (F.col(block) == F.col(p_block))
    )
    position = F.col(slot) * block_rows + F.col(n) % block_rows
    columns = (F.col(block), F.col(release), F.col(deadline), F.col(slot), position)
    return mixed.select(
        *docs.columns,
        *(c.cast("long").alias(name) for c, name in zip(columns, results, strict=True)),
    )


def in_mixed_order(docs: DataFrame, **settings) -> DataFrame:
    """The rows and columns of ``docs``, sorted by their position in the mix."""
    position = fresh(docs, "mix_position")[0]
    return mix_sources(docs, **settings).orderBy(position).select(docs.columns)
