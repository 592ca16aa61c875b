"""Draw the documents that look most like a target, ranked by a regular-sampling sort."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradeflow.llm.common import checkpointed, fresh, ship, tidy

# Words are what stands between ASCII characters other than digits and letters.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
REMEMBERED = 200_000
SEGMENT_ROWS = 1_000_000
SEGMENTS = 4096
SAMPLES_PER_SEGMENT = 16


class Buckets(dict):
    """The bucket of a feature: its crc32 modulo the count. Holds so many features at most."""

    def __init__(self, count: int):
        super().__init__()
        self.count = count

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.count
        if len(self) >= REMEMBERED:
            self.clear()
        if len(feature) <= 64:
            self[feature] = bucket
        return bucket


def feature_buckets(text: bytes | None, most: int, buckets: Buckets) -> list[int]:
    """Buckets of all runs of 1 to ``most`` consecutive words of a text, repeats kept."""
    words = WORD.findall(text.lower()) if text else []
    found = [buckets[w] for w in words]
    for n in range(2, most + 1):
        found += [buckets[b" ".join(words[i : i + n])] for i in range(len(words) - n + 1)]
    return found


def bucket_counts(texts: DataFrame, text: str, count: int, most: int) -> np.ndarray:
    """How many features of all texts fall into each bucket.

    Tasks count their own texts; the aggregate and the driver see ``count`` rows.
    """

    def counted(batches):
        known, total = Buckets(count), np.zeros(count, np.int64)
        for batch in batches:
            for value in batch.column("text").cast(pa.binary()).to_pylist():
                if value:
                    found = np.array(feature_buckets(value, most, known), np.int64)
                    total += np.bincount(found, minlength=count)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    ship(texts.sparkSession)
    rows = (
        texts.select(F.col(text).cast("string").alias("text"))
        .mapInArrow(tidy(counted), "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n"))
        .collect()
    )
    total = np.zeros(count, np.int64)
    for bucket, n in rows:
        total[bucket] = n
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What each bucket tells in favour of the target: 1000 times the log of the ratio of
    its smoothed shares, floored."""
    size = len(source)
    s_all, t_all = int(source.sum()) + size, int(target.sum()) + size
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * float(s_all) / (float(s + 1) * float(t_all))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(key: Column, seed: str) -> Column:
    """1000 times a draw of the Gumbel distribution, floored, fixed by seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _ahead(scores, ids, places) -> np.ndarray:
    """Positions in the order of the ranks: high scores, small ids (null last), early rows."""
    absent = np.array([i is None for i in ids])
    known = np.array([0 if i is None else i for i in ids])
    return np.lexsort((places, known, absent, -np.asarray(scores)))


def _segments_of(rows: list[tuple], splitters: list[tuple]) -> np.ndarray:
    """How many splitters stand before or at each row (score, id, place)."""
    order = _ahead(*zip(*splitters, *rows, strict=True)) if rows else np.zeros(0, np.int64)
    passed = np.cumsum(order < len(splitters))
    found = np.empty(len(order), np.int64)
    found[order] = passed
    return found[len(splitters) :]


def ranked(rows: DataFrame, score: str, key: str, place: str, draw: int, total: int, rank: str):
    """``rows`` (checkpointed, ``total`` of them) with their ranks from 1 to ``draw``.

    Parallel sorting by regular sampling. Every partition is sorted and gives each
    ``stride``-th row of its run; some of these samples, at regular places again, split
    all rows into segments. A segment holds at most its share of samples times the
    stride, and less than one stride more of each run; ``place``, different in every
    row, splits even rows of one score and id. Rows of the segments that are drawn move
    to their segment and are merged there; the counts of the segments before it make
    their rank. The others do not move and get none. The driver sees samples (at most
    16 a segment and one a run) and counts of at most 4,096 segments.
    """
    segment, before, n = fresh(rows, "segment", "before", "n")
    segments = max(1, min(SEGMENTS, -(-total // SEGMENT_ROWS)))
    stride = max(1, total // (segments * SAMPLES_PER_SEGMENT))
    order = [F.col(score).desc(), F.col(key).asc_nulls_last(), F.col(place)]

    def sampled(batches):
        seen = 0
        for batch in batches:
            first = (stride - 1 - seen) % stride
            seen += batch.num_rows
            yield batch.take(pa.array(range(first, batch.num_rows, stride), pa.int64()))

    names = [score, key, place]
    slim = rows.select(*names)
    samples = slim.sortWithinPartitions(*order).mapInArrow(sampled, slim.schema).collect()
    samples = [tuple(r) for r in samples]
    if samples:
        samples = [samples[i] for i in _ahead(*zip(*samples, strict=True))]
    splitters = samples[SAMPLES_PER_SEGMENT - 1 :: SAMPLES_PER_SEGMENT][: SEGMENTS - 1]

    @F.arrow_udf("long")
    def segment_of(
        batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]],
    ) -> Iterator[pa.Array]:
        for columns in batches:
            keys = list(zip(*(c.to_pylist() for c in columns), strict=True))
            yield pa.array(_segments_of(keys, splitters), pa.int64())

    rows = rows.withColumn(segment, segment_of(*map(F.col, names)) if splitters else F.lit(0))
    rows = checkpointed(rows) if splitters else rows
    counts = dict(rows.groupBy(segment).count().collect())
    starts, passed = {}, 0
    for s in sorted(counts):
        starts[s] = passed
        passed += counts[s]
    drawn = [(s, start) for s, start in starts.items() if start < draw]
    last = max((s for s, _ in drawn), default=-1)
    offsets = rows.sparkSession.createDataFrame(drawn, f"`{segment}` long, `{before}` long")
    # At most 4,096 rows, so a broadcast.
    merged = rows.filter(F.col(segment) <= last).withColumn(
        n, F.row_number().over(Window.partitionBy(segment).orderBy(*order))
    )
    merged = merged.join(F.broadcast(offsets), segment).withColumn(
        rank, (F.col(n) + F.col(before)).cast("long")
    )
    merged = merged.withColumn(rank, F.when(F.col(rank) <= draw, F.col(rank)))
    rest = rows.filter(F.col(segment) > last).withColumn(rank, F.lit(None).cast("long"))
    return merged.drop(segment, before, n).unionByName(rest.drop(segment))


def rank_for_target(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    longest_run: int = 1,
    buckets: int = 10_000,
    min_words: int = 20,
    percent: int = 10,
    seed: str = "2024",
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``n_features``, ``weight``, ``score`` and ``rank`` of every row, all long.

    Features are the runs of 1 to ``longest_run`` words of the whole text in lower case
    (A to Z only). ``weight`` is the floored mean gain of a document's features towards
    the target (0 without features: null and empty texts); ``score`` adds noise fixed by
    seed and id, a null id counting as the empty text. Of the documents with
    ``min_words`` words or more, ``percent`` in 100 (rounded down) with the highest
    scores are drawn and ranked from 1, ties to the smaller id, null ids last; rows equal
    in both take different ranks in any order. All other ranks are null. An empty table
    or target gives no error. Results take a leading underscore where ``docs`` has a
    column of their name. Without ``keep_text`` the text does not travel on. Ids are
    whole numbers.
    """
    ship(docs.sparkSession)
    result = fresh(docs, "n_features", "weight", "score", "rank")
    n_features, weight, score, rank = result
    scored, words, place = fresh(docs.select("*", *(F.lit(0).alias(r) for r in result)),
                                 "scored", "words", "place")
    gains = bucket_gains(
        bucket_counts(docs, text, buckets, longest_run),
        bucket_counts(target, target_text, buckets, longest_run),
    )

    @F.arrow_udf("struct<words long, features long, weight long>")
    @tidy
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Buckets(buckets)
        for batch in batches:
            found = []
            for value in batch.cast(pa.binary()).to_pylist():
                at = feature_buckets(value, longest_run, known)
                shorter = longest_run * (longest_run - 1) // 2
                n_words = (len(at) + shorter) // longest_run
                if n_words < longest_run:
                    n_words = len(WORD.findall(value.lower())) if value else 0
                total = int(gains[np.array(at, np.int64)].sum())
                found.append((n_words, len(at), total // len(at) if at else 0))
            columns = zip(*found, strict=True) if found else ([], [], [])
            yield pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["words", "features", "weight"]
            )

    kept = [c for c in docs.columns if keep_text or c != text]
    rows = docs.select(*kept, weigh(F.col(text).cast("string")).alias(scored)).select(
        *kept,
        F.col(scored)["features"].alias(n_features),
        F.col(scored)["weight"].alias(weight),
        (F.col(scored)["weight"] + noise(F.col(id_column), seed)).alias(score),
        F.col(scored)["words"].alias(words),
        F.monotonically_increasing_id().alias(place),
    )
    rows = checkpointed(rows)
    enough = F.col(words) >= min_words
    total = rows.filter(enough).count()
    drawn = ranked(rows.filter(enough), score, id_column, place, percent * total // 100, total, rank)
    rest = rows.filter(~enough).withColumn(rank, F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop(words, place)


def draw_for_target(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with their own columns, best first, as ``rank_for_target`` ranks them."""
    rank = fresh(docs, "n_features", "weight", "score", "rank")[-1]
    found = rank_for_target(docs, target, **options)
    return found.filter(F.col(rank).isNotNull()).orderBy(rank).select(docs.columns)
