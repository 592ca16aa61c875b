"""The operators as queries over the test tables, and SQL twins of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tradeflow.llm.bpe import encode_texts
from tradeflow.llm.codes import compress_vectors, with_group_sum
from tradeflow.llm.common import read
from tradeflow.llm.exact import mark_exact_copies
from tradeflow.llm.importance import rank_for_target
from tradeflow.llm.lines import drop_repeated_lines
from tradeflow.llm.mixing import mix_sources
from tradeflow.llm.passages import mark_repeats
from tradeflow.llm.ranked_bpe import encode_ranked
from tradeflow.llm.setsketch import link_near_copies
from tradeflow.llm.sharding import number_slots, shard_records
from tradeflow.llm.token_counts import count_tokens
from tradeflow.llm.toxicity import fit, held_out, toxicity_score
from tradeflow.llm.vectors import link_vectors

SHARDS = 40
LIMIT = 512
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every document goes when sources are mixed by softened size."""
    return mix_sources(read(spark, sf_dir, "documents").select("doc_id", "source"))


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 equal shards, by the law ``key``."""
    text = F.coalesce("text", F.lit(""))
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return number_slots(shard_records(docs, "doc_id", [1.0] * SHARDS, new_weight=1.0), ["doc_id"])


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that stand earlier in the corpus."""
    return drop_repeated_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of near-equal vectors; labels play no part."""
    return link_vectors(read(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop(
        "embedding"
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents, by four-word shingles."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return link_near_copies(docs, shingle_words=4).drop("text")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, by a model of the labels that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        toxicity_score(docs, F.col("text"), model).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document and of the text they decode to."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = encode_texts(docs, F.col("text"), WORD_FILE, with_ids=False, remembered=400_000)
    return docs.select("doc_id", tokens.alias("t")).select(
        "doc_id", "t.n_tokens", "t.ids_sha256", "t.decoded_sha256"
    )


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of every document that stand earlier in the corpus."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return mark_repeats(docs).select(
        "doc_id",
        "n_repeated_words",
        F.array_sort(F.array_distinct("repeats.source")).alias("sources"),
        "repeats",
    )


def op9_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for its text."""
    return mark_exact_copies(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tokens of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        count_tokens(docs, F.col("text"), BYTE_FILE).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > LIMIT)


def op11_ranked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ranked token ids of every document and of what they decode to."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = encode_ranked(
        docs, F.col("text"), RANK_FILE, public_tokenizers.PATTERN, with_ids=False
    )
    return docs.select("doc_id", tokens.alias("t")).select(
        "doc_id", "t.n_tokens", "t.ids_sha256", "t.decoded_sha256"
    )


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much every document is like the benchmark, and the rank of those drawn for it."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return rank_for_target(docs, read(spark, sf_dir, "benchmark"), keep_text=False)


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every usable vector, and what is lost by it, also by label."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded = compress_vectors(vectors).drop("embedding")
    return with_group_sum(coded, "label", "error", "label_error").drop("label")


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_mix": op1_mix,
    "op2_shard": op2_shard,
    "op3_lines": op3_lines,
    "op4_vectors": op4_vectors,
    "op5_minhash": op5_minhash,
    "op6_toxicity": op6_toxicity,
    "op7_bpe": op7_bpe,
    "op8_passages": op8_passages,
    "op9_exact": op9_exact,
    "op10_token_count": op10_token_count,
    "op11_ranked_bpe": op11_ranked_bpe,
    "op12_importance": op12_importance,
    "op13_codes": op13_codes,
}

ORACLE: dict[str, str] = {
    "op9_exact": r"""
        WITH plain AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g'))
                       AS text_sha256
            FROM documents
        ), grouped AS (
            SELECT doc_id, text_sha256,
                   first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
                       AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM plain
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped
    """,
    "op12_importance": r"""
        WITH words AS (
            SELECT 0 AS side, doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
            UNION ALL
            SELECT 1, NULL, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
        ), spelled AS (
            SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)
        ), bucketed AS (
            SELECT word, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2),
                    lambda i: ('0x' || h[i:i + 1])::BIGINT)),
                lambda crc, byte: list_reduce(
                    [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                    lambda c, bit: xor(c >> 1, 3988292384 * (c & 1))))) % 10000 AS bucket
            FROM spelled
        ), found AS (
            SELECT side, doc_id, bucket FROM words JOIN bucketed USING (word)
        ), counts AS (
            SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
            FROM found GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
            FROM counts
        ), weighed AS (
            SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
            FROM found JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id
        ), scored AS (
            SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln(
                    (('0x' || sha256('2024:' || d.doc_id)[1:8])::BIGINT + 0.5::DOUBLE)
                    / 4294967296)))::BIGINT AS score
            FROM documents d LEFT JOIN weighed w ON w.doc_id = d.doc_id
        ), ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank,
                10 * count(*) OVER () // 100 AS drawn
            FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score,
            CASE WHEN rank <= drawn THEN rank END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)
    """,
}
