"""Line dedup: winnowing over line hashes finds runs of lines that occur earlier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import checkpointed, fresh, ship, tidy
from tradeflow.llm.merges import slices
from tradeflow.llm.shingles import spans_hashed

# Production setting: runs of so many equal lines are found without fail.
MIN_LINES = 2


def text_lines(text: str | None) -> tuple[list[str], list[int]]:
    """All lines of a text, and the numbers of those that are not blank."""
    lines = (text or "").split("\n")
    return lines, [i for i, line in enumerate(lines) if line.strip()]


def line_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each line that is not blank, without outer blanks; index of its text)."""
    lines, owner = [], []
    for k, text in enumerate(texts):
        own = [s.encode("utf-8", "surrogatepass") for x in text.split("\n") if (s := x.strip())]
        lines += own
        owner.append(np.full(len(own), k))
    sizes = np.array([len(x) + 1 for x in lines], np.int64)
    stops = np.cumsum(sizes) - 1
    buffer = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    return spans_hashed(buffer, stops - sizes + 1, stops), np.concatenate(owner)


def winnow(hashes: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(position of a minimum, first and last window start that it is the minimum of).

    Of equal minima the last counts. Each window of ``width`` hashes has one
    fingerprint, so two equal runs of that length share theirs.
    """
    if len(hashes) < width:
        return []
    windows = np.lib.stride_tricks.sliding_window_view(hashes, width)
    at = width - 1 - np.argmin(windows[:, ::-1], axis=1) + np.arange(len(windows))
    change = np.flatnonzero(at[1:] != at[:-1]) + 1
    return [
        (int(at[a]), int(a), int(b) - 1)
        for a, b in zip([0, *change], [*change, len(at)], strict=True)
    ]


def _fingerprints(width: int):
    @tidy
    def fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = iter(batch["doc"])
            for texts in slices(t or "" for t in batch["text"]):
                hashes, owner = line_hashes(texts)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                rows = []
                for a, b in zip(cuts, cuts[1:], strict=False):
                    doc, own = next(ids), hashes[a:b]
                    signed = own.view(np.int64)
                    for at, low, high in winnow(own, width):
                        rows.append((doc, signed[at], low, signed[low : high + width]))
                yield pd.DataFrame(rows, columns=["doc", "mark", "start", "context"])

    return fingerprints


def _without(width: int):
    def without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts in batches:
            rows = []
            for text, start in zip(texts, starts, strict=True):
                lines, full = text_lines(text)
                gone = set()
                if start is not None:
                    gone = {full[i] for s in start for i in range(s, s + width)}
                kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
                rows.append((len(full), len(gone), text if text is None else kept))
            yield pd.DataFrame(rows, columns=["n_lines", "n_removed", "text"])

    return without


def drop_repeated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_lines: int = MIN_LINES,
) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted, and (n_lines, n_removed).

    A run of at least ``min_lines`` lines that also stands at an earlier place, in the
    order of (id, line), goes; the first occurrence stays. Lines are compared without
    outer blanks; blank lines neither count nor go. So a line goes if and only if it
    is one of ``min_lines`` lines in a row that stood in this order before.

    The minimum of each window of ``min_lines`` line hashes is a fingerprint. Windows
    of fingerprints that occur once are left; the others extend to both sides of
    their fingerprint, and each is compared with the first place of its lines.
    First places come from an aggregate that combines before the shuffle, and both
    sides of the joins are checkpoints, so Spark can split a line that very many
    documents hold. Only the numbers of a document's own windows meet in one row.

    Null texts stay null. Rows of one id are one place, a null id is a place after
    all others; ids must be integers. Columns of ``docs`` with the names of results
    are replaced.
    """
    docs = docs.drop(*[c for c in ("n_lines", "n_removed") if c not in (id_column, text_column)])
    ship(docs.sparkSession)
    place = F.coalesce(F.col(id_column).cast("long"), F.lit(2**63 - 1))
    marks = checkpointed(
        docs.select(place.alias("doc"), F.col(text_column).alias("text")).mapInPandas(
            _fingerprints(min_lines), "doc long, mark long, start int, context array<long>"
        )
    )
    repeated = checkpointed(
        marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark")
    )
    windows = checkpointed(
        marks.join(repeated, "mark", "left_semi").select(
            "doc",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(1), F.size("context") - min_lines + 1),
                    lambda k: F.struct(
                        F.xxhash64(F.slice("context", k, min_lines)).alias("one"),
                        F.xxhash64(F.lit("two"), F.slice("context", k, min_lines)).alias("two"),
                    ),
                )
            ).alias("k", "key"),
            "start",
        ).select("doc", (F.col("start") + F.col("k")).alias("start"), "key.one", "key.two")
    )
    where = F.col("doc").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(11,0)") + F.col(
        "start"
    ).cast("decimal(11,0)")
    first = checkpointed(
        windows.groupBy("one", "two")
        .agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    later = (
        windows.join(first, ["one", "two"])
        .filter(where > F.col("first"))
        .groupBy("doc")
        .agg(F.array_sort(F.collect_set("start")).alias("starts"))
    )
    doc, starts, result = fresh(docs, "doc", "starts", "result")
    later = checkpointed(later.toDF(doc, starts))
    clean = F.pandas_udf(_without(min_lines), "n_lines int, n_removed int, text string")
    joined = docs.join(later, place == F.col(doc), "left").withColumn(
        result, clean(F.col(text_column), F.col(starts))
    )
    return joined.select(
        *[
            F.col(f"{result}.text").alias(c) if c == text_column else F.col(c)
            for c in docs.columns
        ],
        f"{result}.n_lines",
        f"{result}.n_removed",
    )
