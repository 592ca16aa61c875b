"""MinHash near-dedup with SetSketch registers: bands, joint likelihood, exact check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import checkpointed, components, fresh, shielded, ship, tidy
from tradeflow.llm.merges import slices
from tradeflow.llm.shingles import GOLDEN, mix, shingle_sets

# Production settings.
RESULTS = ["n_shingles", "component_id", "kept"]
SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
REGISTERS = 256
ROWS, BANDS = 5, 25  # registers to a band, bands; the others only serve the estimate
BASE = 1.001  # the minima are kept as powers of this
RATE = 20.0
LARGEST = 65_535
BLOCK = 400
# Four standard deviations of the estimate at a similarity of 0.8.
MARGIN = 4 * (0.8 * 0.2 / REGISTERS) ** 0.5


def registers(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """The SetSketch of each set: register i keeps floor(1 - log_b x), at least 0, of
    the smallest exponential variate x that an element throws at it.

    An element throws the points of a Poisson process, each at a random register;
    a register sees independent processes of rate ``RATE``. Only points below a
    limit matter, of which a set of any size has about m (ln m + 10); if one
    register stays without, the limit doubles for that set. So the work for a set
    is its size and that constant, and merging is the larger register of two.
    """
    result = np.zeros((len(sets), m), np.uint16)
    todo = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    limit = np.log(m) + 10.0
    while len(todo):
        sizes = np.array([len(sets[i]) for i in todo])
        element = np.concatenate([sets[i] for i in todo])
        owner = np.repeat(np.arange(len(todo)), sizes)
        bound = (limit / sizes)[owner]
        least = np.full(len(todo) * m, np.inf)
        time = np.zeros(len(element))
        step = 0
        while len(element):
            # The last few elements, of small sets, throw many points at a time.
            k = min(256, max(1, 8192 // len(element)))
            drawn = mix(element[:, None] + np.arange(step + 1, step + k + 1, dtype=np.uint64) * GOLDEN)
            gaps = np.log(((drawn >> np.uint64(11)) + 0.5) * 2.0**-53) / -m
            times = time[:, None] + (np.cumsum(gaps, axis=1) if k > 1 else gaps)
            near = times < bound[:, None]
            aim = (mix(drawn[near] ^ GOLDEN) % np.uint64(m)).astype(np.int64)
            where = np.broadcast_to(owner[:, None], near.shape)[near] * m + aim
            np.minimum.at(least, where, times[near])
            alive = near[:, -1]
            element, owner, bound = element[alive], owner[alive], bound[alive]
            time = times[alive, -1]
            step += k
        least = least.reshape(len(todo), m)
        full = np.isfinite(least).all(axis=1)
        value = np.floor(1 - np.log(least[full] / RATE) / np.log(BASE))
        result[todo[full]] = np.clip(value, 0, LARGEST).astype(np.uint16)
        todo = todo[~full]
        limit *= 2
    return result


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def band_hashes(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash for each band of ``rows`` register values, different for each band."""
    bands = min(BANDS, sketch.shape[1] // rows)
    parts = sketch[:, : bands * rows].reshape(len(sketch), bands, rows).astype(np.uint64)
    total = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN), parts.shape[:2])
    for r in range(rows):
        total = mix(total + GOLDEN + parts[:, :, r])
    return total.view(np.int64)


def likely_jaccard(
    larger: np.ndarray, smaller: np.ndarray, m: int, n_a: np.ndarray, n_b: np.ndarray
) -> np.ndarray:
    """The Jaccard similarity of greatest likelihood, given how many registers of the
    first sketch are larger and smaller than the second's, and both set sizes."""
    share = n_a / (n_a + n_b)
    low, high = np.zeros(len(share)), np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    equal = m - larger - smaller

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        up, down = chance(share - (1 - share) * j), chance(1 - share - share * j)
        return sum(
            np.where(n > 0, n * np.log(np.maximum(p, 1e-300)), 0.0)
            for n, p in ((larger, up), (smaller, down), (equal, 1 - up - down))
        )

    golden = (5**0.5 - 1) / 2
    for _ in range(40):
        left, right = high - golden * (high - low), low + golden * (high - low)
        better = likelihood(left) >= likelihood(right)
        low, high = np.where(better, low, left), np.where(better, right, high)
    return (low + high) / 2


def _sketched(shingle_words: int, m: int, rows: int):
    @tidy
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = iter(batch["node"])
            for texts in slices(t or "" for t in batch["text"]):
                sets = list(shingle_sets(texts, shingle_words))
                regs = registers(sets, m)
                bands = band_hashes(regs, rows)
                sums = [mix(s ^ (s >> np.uint64(7))).sum(dtype=np.uint64) for s in sets]
                yield pd.DataFrame(
                    {
                        "node": [next(ids) for _ in texts],
                        "n": [len(s) for s in sets],
                        "digest_1": np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
                        .view(np.int64),
                        "digest_2": np.array(sums, np.uint64).view(np.int64),
                        "regs": [r.tobytes() for r in regs],
                        "bands": list(bands),
                    }
                )

    return sketch


def _likely(m: int, least: float):
    @tidy
    def likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            a = np.frombuffer(b"".join(batch["regs_a"]), np.uint16).reshape(-1, m)
            b = np.frombuffer(b"".join(batch["regs_b"]), np.uint16).reshape(-1, m)
            j = likely_jaccard(
                (a > b).sum(1), (a < b).sum(1), m, batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
            )
            yield batch.loc[j >= least, ["a", "b"]]

    return likely


def _sets(shingle_words: int):
    @tidy
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = iter(batch["node"])
            for texts in slices(t or "" for t in batch["text"]):
                found = [s.tobytes() for s in shingle_sets(texts, shingle_words)]
                yield pd.DataFrame({"node": [next(ids) for _ in texts], "shingles": found})

    return sets


def _linked(percent: int):
    @tidy
    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["set_a"], batch["set_b"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum()) if len(x) else 0
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    return linked


def _common(sets: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """How many elements each of the sorted sets has in common with ``x``."""
    flat = np.concatenate(sets)
    hit = x[np.minimum(np.searchsorted(x, flat), len(x) - 1)] == flat
    sizes = np.array([len(y) for y in sets])
    return np.add.reduceat(hit, np.cumsum(sizes) - sizes)


class Crossing:
    """Pairs of a bucket's blocks that are likely and in different components.

    ``involved`` passes on the rows that have such a pair, ``linked`` checks the pairs
    on the full sets and gives an edge for each row to the least one it is linked to:
    neither puts out pairs.
    """

    def __init__(self, m: int, rows: int, least: float, percent: int):
        self.m, self.rows, self.least, self.percent = m, rows, least, percent

    def _pairs(self, data: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        where = data[["bucket", "i", "j"]].to_numpy()
        cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
        comp, n = data["component"].to_numpy(), data["n"].to_numpy()
        block, regs = data["block"].to_numpy(), data["regs"].to_numpy()
        held = []
        for s, e in zip([0, *cuts], [*cuts, len(data)], strict=True):
            if (comp[s:e] == comp[s]).all():
                continue
            own = np.frombuffer(b"".join(regs[s:e]), np.uint16).reshape(-1, self.m)
            bands = band_hashes(own, self.rows)
            bucket, i, j = where[s]
            left, right = (np.flatnonzero(block[s:e] == k) for k in (i, j))
            for x in left:
                other = right[right > x] if i == j else right
                other = other[comp[s:e][other] != comp[s + x]]
                small = np.minimum(n[s:e][other], n[s + x])
                large = np.maximum(n[s:e][other], n[s + x])
                other = other[100 * small >= self.percent * large]
                if not len(other):
                    continue
                # A pair counts in the first band it shares.
                shared = bands[other] == bands[x]
                other = other[bands[x][shared.argmax(axis=1)] == bucket]
                # Two sketches agree in about as many registers as the sets are similar.
                equal = (own[x] == own[other]).sum(1)
                other = other[equal >= self.m * (self.least - 0.1)]
                if len(other):
                    above, below = (own[x] > own[other]).sum(1), (own[x] < own[other]).sum(1)
                    held.append((np.full(len(other), s + x), s + other, above, below))
            if sum(len(h[0]) for h in held) > 50_000:
                yield self._likely(held, n)
                held = []
        if held:
            yield self._likely(held, n)

    def _likely(self, held, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, above, below = (np.concatenate(c) for c in zip(*held, strict=True))
        j = likely_jaccard(above, below, self.m, n[a], n[b])
        return a[j >= self.least], b[j >= self.least]

    @staticmethod
    def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows again, none of a group in two frames."""
        held: list[pd.DataFrame] = []
        for batch in batches:
            keys = batch[["bucket", "i", "j"]]
            same = (keys == keys.iloc[-1]).all(axis=1)
            if not same.all():
                yield pd.concat([*held, batch[~same]], ignore_index=True)
                held = []
            held.append(batch[same])
        if held:
            yield pd.concat(held, ignore_index=True)

    def involved(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for data in self._whole(batches):
            found = [np.unique(np.concatenate(pair)) for pair in self._pairs(data)]
            if found:
                yield data.iloc[np.unique(np.concatenate(found))]

    def linked(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for data in self._whole(batches):
            sets = [np.frombuffer(x, np.uint64) for x in data["shingles"]]
            node, n = data["node"].to_numpy(), data["n"].to_numpy()
            for a, b in self._pairs(data):
                cuts = np.flatnonzero(a[1:] != a[:-1]) + 1
                edges = []
                for s, e in zip([0, *cuts], [*cuts, len(a)], strict=True):
                    x, other = a[s:e], b[s:e]
                    if not len(x):
                        continue
                    both = _common([sets[k] for k in other], sets[x[0]])
                    link = 100 * both >= self.percent * (n[x] + n[other] - both)
                    if link.any():
                        ends = np.append(node[other[link]], node[x[0]])
                        edges.append(
                            pd.DataFrame({"a": np.full(len(ends), ends.min()), "b": ends})
                        )
                if edges:
                    yield pd.concat(edges).drop_duplicates()


def link_near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    percent: int = THRESHOLD_PERCENT,
    m: int = REGISTERS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """``docs`` with (n_shingles, component_id, kept), one row per input row.

    Documents are linked when 100 * common shingles >= ``percent`` * all shingles of
    the two, and a component is what links connect; the row of its smallest id is
    kept. Candidates are documents that share a band of register values; of these,
    pairs whose likely similarity is not four deviations below the threshold are
    checked on their full sets. With 25 bands of five, a pair at exactly 0.8 is
    missed with a chance of 8 in 100,000, a closer one less often.

    Documents with equal sets are one class, so copies make no pairs. Per bucket,
    every class is first compared with the smallest id there, which joins large
    groups of near copies by as many pairs as members. Only classes of a bucket that
    are then still in different components are compared with each other, in blocks
    of at most ``block`` classes that meet two by two; no pair is left out for the
    size of a bucket.

    Documents without words, and rows with a null id, are linked with nothing and
    kept. Rows of one id are one document in links. Ids must be integers. Columns of
    ``docs`` with the names of results are replaced.
    """
    docs = docs.drop(*[c for c in RESULTS if c not in (id_column, text_column)])
    ship(docs.sparkSession)
    least = percent / 100 - MARGIN
    texts = docs.select(
        F.col(id_column).cast("long").alias("node"), F.col(text_column).alias("text")
    ).filter("node IS NOT NULL")
    sketches = checkpointed(
        texts.mapInPandas(
            _sketched(shingle_words, m, rows),
            "node long, n long, digest_1 long, digest_2 long, regs binary, bands array<long>",
        )
    )
    classes = checkpointed(
        sketches.filter("n > 0").groupBy("n", "digest_1", "digest_2").agg(F.min("node").alias("rep"))
    )
    # One sketch for each class: that of its smallest id.
    heads = sketches.join(
        classes.select("n", "digest_1", "digest_2", F.col("rep").alias("node")),
        ["n", "digest_1", "digest_2", "node"],
        "left_semi",
    ).select("node", "n", "regs", "bands")
    heads = checkpointed(heads.dropDuplicates(["node"]))
    members = heads.select("node", "n", F.explode("bands").alias("bucket"))
    hubs = checkpointed(
        members.groupBy("bucket")
        .agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1")
    )
    sketch = heads.select("node", "n", "regs")

    def sketch_of(side: str) -> DataFrame:
        return sketch.toDF(side, f"n_{side}", f"regs_{side}")

    def sets_of(nodes: DataFrame) -> DataFrame:
        return texts.join(nodes, "node", "left_semi").mapInPandas(
            _sets(shingle_words), "node long, shingles binary"
        )

    stars = checkpointed(
        members.join(hubs, "bucket")
        .filter("node <> hub")
        .select(F.col("hub").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    likely = checkpointed(
        stars.join(sketch_of("b"), "b")
        .join(sketch_of("a"), "a")
        .filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        .mapInPandas(_likely(m, least), "a long, b long")
    )
    needed = likely.select("a").union(likely.select("b")).distinct().toDF("node")
    sets = checkpointed(sets_of(needed))
    links = checkpointed(
        likely.join(sets.toDF("b", "set_b"), "b")
        .join(sets.toDF("a", "set_a"), "a")
        .mapInPandas(_linked(percent), "a long, b long")
    )
    first = components(links)

    # Buckets that still hold several components.
    labelled = (
        members.join(hubs, "bucket")
        .join(first, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    labelled = checkpointed(labelled.select("bucket", "node", "component", "size"))
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("bucket")
    )
    mixed = checkpointed(mixed)
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(F.col("block"), other).alias("i"), F.greatest(F.col("block"), other).alias("j")
        ),
    )
    crossing = Crossing(m, rows, least, percent)
    kind = "bucket long, node long, component long, n long, regs binary, block int, i int, j int"
    involved = checkpointed(
        labelled.join(mixed, "bucket", "left_semi")
        .withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .join(sketch, "node")
        .select("bucket", "node", "component", "n", "regs", "block", F.inline(meets).alias("i", "j"))
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j", "node")
        .mapInPandas(tidy(crossing.involved), kind)
    )
    more = checkpointed(
        involved.join(sets_of(involved.select("node").distinct()), "node")
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j", "node")
        .mapInPandas(tidy(crossing.linked), "a long, b long")
        .filter("a <> b")
    )
    reached = components(links.union(more))

    node, digest, component = fresh(docs, "node", "digest", "component")
    by_class = checkpointed(
        classes.join(reached, F.col("rep") == F.col("node"), "left").select(
            "n", "digest_1", "digest_2", F.coalesce("component", "rep").alias("component")
        )
    )
    by_node = sketches.select("node", "n", "digest_1", "digest_2").join(
        by_class, ["n", "digest_1", "digest_2"], "left"
    )
    by_node = (
        by_node.groupBy(F.col("node").alias(node))
        .agg(F.max("n").alias(digest), F.min("component").alias(component))
    )
    result = docs.join(by_node, F.col(id_column).cast("long") == F.col(node), "left")
    component_id = F.coalesce(F.col(component), F.col(id_column).cast("long"))
    return result.select(
        *docs.columns,
        F.coalesce(F.col(digest), F.lit(0)).cast("long").alias("n_shingles"),
        component_id.alias("component_id"),
        F.coalesce(component_id == F.col(id_column), F.lit(True)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of each group of near copies.

    All columns keep their values.
    """
    named = {k: v for k, v in settings.items() if k.endswith("_column")}
    return shielded(docs, RESULTS, lambda d: link_near_copies(d, **settings).filter("kept"), **named)
