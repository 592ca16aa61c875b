"""Exact dedup: group by a 128-bit content hash, compare bytes inside the groups."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import checkpointed, fresh, shielded

# The characters that do not count, [\x20\x09-\x0D].
RESULTS = ["keep_id", "group_size", "kept", "text_sha256"]
BLANK = "[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def mark_exact_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """``docs`` with (keep_id, group_size, kept, text_sha256), one row per input row.

    Rows whose texts are equal without blanks form a group; the row with the most
    code points in the original text stays, then the one with the smallest id.

    Whole texts meet in one aggregate keyed by hash *and* text, which compares
    their bytes and combines before the shuffle: a hot text travels once per task.
    From then on a row finds its group by the hash alone, unless that aggregate has
    seen two texts under one hash: the rows of such hashes are joined by their texts.

    Null ids sort after all others. Rows with the same id and equally long equal
    texts cannot be told apart: they stay or go together. Columns of ``docs`` named
    like a result are replaced. An empty table gives an empty result.
    """
    docs = docs.drop(*[c for c in RESULTS if c not in (id_column, text_column)])
    digest, text, length, hash_, texts, size, keeper, best, own, of_text, sha = fresh(
        docs, "digest", "plain", "length", "hash", "texts", "size", "keeper", "best", "own",
        "of_text", "sha",
    )

    identity = F.coalesce(
        F.col(id_column).cast("decimal(20,0)"), F.lit(Decimal(2**63)).cast("decimal(20,0)")
    )
    rank = F.col(length).cast("decimal(10,0)") * F.lit(Decimal(2**65)).cast(
        "decimal(20,0)"
    ) - identity
    plain = docs.withColumn(text, normalised(F.col(text_column)))
    keyed = plain.withColumns(
        {hash_: hashed(F.col(text)), length: F.length(F.coalesce(text_column, F.lit("")))}
    )
    chosen = [F.max_by(keeper, best).alias(keeper), F.max(best).alias(best)]
    by_text = (
        keyed.select(hash_, text, F.col(id_column).alias(keeper), rank.alias(best))
        .groupBy(hash_, text)
        .agg(F.count(F.lit(1)).alias(size), *chosen)
    )
    by_hash = checkpointed(
        by_text.groupBy(F.col(hash_).alias(digest)).agg(
            F.count(F.lit(1)).alias(texts), F.sum(size).alias(size), *chosen
        )
    )
    rows = keyed.withColumns({sha: F.sha2(text, 256), own: rank})
    columns = [*docs.columns, keeper, size, best, own, sha]
    alone = by_hash.filter(F.col(texts) == 1)
    result = rows.join(alone, F.col(hash_) == F.col(digest)).select(*columns)
    if not by_hash.filter(F.col(texts) > 1).isEmpty():
        shared = by_hash.filter(F.col(texts) > 1).select(digest)
        groups = by_text.join(shared, F.col(hash_) == F.col(digest), "left_semi").toDF(
            digest, of_text, size, keeper, best
        )
        same = (F.col(hash_) == F.col(digest)) & (F.col(text) == F.col(of_text))
        result = result.unionByName(rows.join(groups, same).select(*columns))
    return result.select(
        *docs.columns,
        F.col(keeper).alias("keep_id"),
        F.col(size).alias("group_size"),
        (F.col(own) == F.col(best)).alias("kept"),
        F.col(sha).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, **columns) -> DataFrame:
    """``docs`` without the rows that an equal text replaces; all columns keep their values."""
    return shielded(
        docs, RESULTS, lambda d: mark_exact_copies(d, **columns).filter("kept"), **columns
    )
