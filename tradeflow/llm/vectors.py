"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import checkpointed, components, fresh, ship, tidy

# Production settings.
THRESHOLD = 0.9
TABLES_PER_HASH = 5
PROBES = 4
BLOCK = 1000
SEED = 20240117


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two."""
    rows, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(rows, -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(rows, width) / np.sqrt(width)


def bucket_codes(unit: np.ndarray, hashes: int, tables: int, probes: int) -> np.ndarray:
    """The (rows, tables, probes) buckets of unit vectors, each a number of its own table.

    A hash turns the vector by three rounds of random signs and Hadamard transform
    and takes the closest of the 2d signed axes. A table joins ``hashes`` of them.
    Besides the closest axes, a vector probes the combinations that lose least.
    """
    rows, d = unit.shape
    width = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((rows, width))
    padded[:, :d] = unit
    signs = np.random.default_rng([SEED, width]).choice([-1.0, 1.0], (tables, hashes, 3, width))
    near = min(3, width)
    every = np.arange(rows)[:, None]
    result = np.empty((rows, tables, probes), np.int64)
    for t in range(tables):
        codes = np.full((rows, 1), t + 1, np.int64)
        loss = np.zeros((rows, 1))
        for h in range(hashes):
            y = padded
            for s in signs[t, h]:
                y = hadamard(y * s)
            size = np.abs(y)
            top = np.argpartition(-size, near - 1, axis=1)[:, :near]
            axis = top * 2 + (np.take_along_axis(y, top, 1) < 0)
            gap = size.max(axis=1, keepdims=True) ** 2 - np.take_along_axis(size, top, 1) ** 2
            codes = (codes[:, :, None] * (2 * width) + axis[:, None, :]).reshape(rows, -1)
            loss = (loss[:, :, None] + gap[:, None, :]).reshape(rows, -1)
            keep = np.argsort(loss, axis=1, kind="stable")[:, :probes]
            codes, loss = codes[every, keep], loss[every, keep]
        short = probes - codes.shape[1]
        result[:, t] = np.pad(codes, ((0, 0), (0, short)), mode="edge") if short else codes
    return result


def unit_rows(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches by the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


class Meeting:
    """Two blocks of a bucket, or one with itself: unit vectors, their ids and copies."""

    def __init__(self, data: pd.DataFrame):
        self.reps, self.copies = data["rep"].to_numpy(), data["copies"].to_numpy()
        i, j = data["i"].iloc[0], data["j"].iloc[0]
        self.alone = i == j
        self.left = np.flatnonzero(data["block"].to_numpy() == i)
        self.right = np.flatnonzero(data["block"].to_numpy() == j)
        unit = np.empty((len(data), 0))
        lengths = data["vector"].map(len).to_numpy()
        if len(data) and (lengths == lengths[0]).all():
            unit = unit_rows(data["vector"])
        self.unit, self.lengths = unit, lengths
        self.data = data

    def close(self, threshold: float) -> np.ndarray:
        """Which of the left are linked with which of the right, nothing with itself."""
        if self.unit.shape[1]:
            close = self.unit[self.left] @ self.unit[self.right].T >= threshold
        else:  # vectors of different lengths are never linked
            close = np.zeros((len(self.left), len(self.right)), bool)
            for width in np.unique(self.lengths):
                x = np.flatnonzero(self.lengths[self.left] == width)
                y = np.flatnonzero(self.lengths[self.right] == width)
                if len(x) and len(y):
                    u = unit_rows(self.data["vector"].iloc[self.left[x]])
                    v = unit_rows(self.data["vector"].iloc[self.right[y]])
                    close[np.ix_(x, y)] = u @ v.T >= threshold
        if self.alone:
            np.fill_diagonal(close, False)
        return close


def _edges(meeting: Meeting, threshold: float) -> pd.DataFrame:
    """One edge for each vector that is linked: to the first of its component here."""
    close = meeting.close(threshold)
    label = np.arange(len(meeting.reps))
    far = len(label)
    while True:
        new = label.copy()
        across = np.where(close, label[meeting.right], far).min(axis=1, initial=far)
        new[meeting.left] = np.minimum(new[meeting.left], across)
        back = np.where(close, new[meeting.left][:, None], far).min(axis=0, initial=far)
        new[meeting.right] = np.minimum(new[meeting.right], back)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(label)))
    return pd.DataFrame({"a": meeting.reps[moved], "b": meeting.reps[label[moved]]})


def _counts(meeting: Meeting, threshold: float) -> pd.DataFrame:
    """How many vectors of the other block each is linked with, copies counted."""
    close = meeting.close(threshold)
    total = np.zeros(len(meeting.reps), np.int64)
    total[meeting.left] += close @ meeting.copies[meeting.right]
    if not meeting.alone:
        total[meeting.right] += close.T @ meeting.copies[meeting.left]
    linked = np.flatnonzero(total)
    return pd.DataFrame({"a": meeting.reps[linked], "links": total[linked]})


def _by_meeting(work):
    """``work`` on each meeting of sorted batches; a task holds one meeting at a time."""

    @tidy
    def worked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            last = batch.iloc[-1]
            open_ = (batch["bucket"] == last["bucket"]) & (batch["i"] == last["i"])
            open_ &= batch["j"] == last["j"]
            if not open_.all():
                yield from each(pd.concat([*held, batch[~open_]]))
                held = []
            held.append(batch[open_])
        if held:
            yield from each(pd.concat(held))

    def each(data: pd.DataFrame) -> Iterator[pd.DataFrame]:
        where = data[["bucket", "i", "j"]].to_numpy()
        cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
        found = [
            work(Meeting(data.iloc[a:b]))
            for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)
            if b - a > 1
        ]
        if found:
            yield pd.concat(found)

    return worked


def _meetings(members: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """The classes of every bucket of ``members`` (bucket, rep), in blocks two by two."""
    sizes = (
        members.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
        .drop("n")
    )
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    pairs_of_blocks = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(F.col("block"), other).alias("i"), F.greatest(F.col("block"), other).alias("j")
        ),
    )
    return (
        members.join(sizes, "bucket")
        .withColumn("block", own)
        .join(classes, "rep")
        .select(
            "bucket", "block", "rep", "copies", "vector", F.inline(pairs_of_blocks).alias("i", "j")
        )
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
    )


def link_vectors(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
    tables_per_hash: int = TABLES_PER_HASH,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """``df`` with (n_links, component_id, kept), one row per input row.

    Two vectors are linked when their cosine, in double precision, reaches
    ``threshold``; ``n_links`` counts the other vectors a vector is linked with,
    ``component_id`` is the smallest id reachable by links, and the vector of that
    id is kept. Candidates are vectors that share a bucket of a cross-polytope
    table; every candidate pair is compared, none below the threshold is linked. Links
    are counted once, between all vectors of a component.

    Equal vectors are one class with a count, so copies make no pairs. Only classes
    that share a bucket get their vectors sent there. A bucket of more than ``block``
    classes is cut into blocks that meet two by two, so no task holds more than two
    blocks. A task returns one edge, or one count, per vector, not pairs.

    Vectors that are null, empty, zero or hold null or non-finite values, and rows
    with a null id, are linked with nothing and kept under their own id. Vectors of
    different lengths are never compared. Rows of one id count as separate vectors.
    Columns of ``df`` with the names of results are replaced.
    """
    results = ["n_links", "component_id", "kept"]
    df = df.drop(*[c for c in results if c not in (id_column, vector_column)])
    ship(df.sparkSession)
    vector, rep, copies, links = fresh(df, "vector", "rep", "copies", "links")
    finite = F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    usable = (
        F.col(id_column).isNotNull()
        & (F.size(vector) > 0)
        & finite
        & F.exists(F.col(vector), lambda x: x != 0)
    )
    rows = df.withColumn(vector, F.col(vector_column).cast("array<double>"))
    rows = rows.withColumn(
        vector, F.when(usable, F.transform(F.col(vector), lambda x: x + F.lit(0.0)))
    )
    classes = checkpointed(
        rows.filter(F.col(vector).isNotNull())
        .groupBy(F.col(vector).alias("vector"))
        .agg(F.min(id_column).cast("long").alias("rep"), F.count(F.lit(1)).alias("copies"))
    )
    n, width = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    # So many axes that about one unrelated vector falls into a bucket.
    hashes = max(1, ceil(log(max(n, 2)) / log(2 * max(width or 2, 2))))
    tables = tables_per_hash * hashes

    @tidy
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, same in batch.groupby(batch["vector"].map(len)):
                codes = bucket_codes(unit_rows(same["vector"]), hashes, tables, probes)
                codes = codes.reshape(len(same), -1)
                codes = codes * 4099 + same["vector"].map(len).to_numpy()[:, None]
                for k in range(0, len(same), 2000):
                    part = codes[k : k + 2000]
                    ids = np.repeat(same["rep"].to_numpy()[k : k + 2000], part.shape[1])
                    yield pd.DataFrame({"bucket": part.ravel(), "rep": ids}).drop_duplicates()

    buckets = checkpointed(classes.mapInPandas(hashed, "bucket long, rep long"))
    edges = _meetings(buckets, classes, block).mapInPandas(
        _by_meeting(lambda m: _edges(m, threshold)), "a long, b long"
    )
    reached = checkpointed(components(checkpointed(edges)))
    # All linked pairs lie inside a component: there each is counted once.
    inside = reached.select(F.col("component").alias("bucket"), F.col("node").alias("rep"))
    counts = _meetings(inside, classes, block).mapInPandas(
        _by_meeting(lambda m: _counts(m, threshold)), "a long, links long"
    )
    counted = counts.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n"))
    by_class = (
        classes.join(counted, F.col("rep") == F.col("node"), "left")
        .drop("node")
        .join(reached, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("vector").alias("of_vector"),
            F.coalesce("component", "rep").alias(rep),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias(links),
        )
    )
    by_class = checkpointed(by_class)
    joined = rows.join(by_class, rows[vector] == by_class["of_vector"], "left")
    component = F.coalesce(F.col(rep), F.col(id_column))
    return joined.select(
        *df.columns,
        F.coalesce(F.col(links), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col(id_column), F.lit(True)).alias("kept"),
    )
