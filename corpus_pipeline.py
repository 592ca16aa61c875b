"""From raw documents to token ids: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and is written and read again before the next.
All but the last return the columns of ``documents``; mixing adds the place of each
document in the mix, which the token ids carry on. Further columns of the documents keep
their values under their names, whatever these are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm.bpe import encode_texts
from tradeflow.llm.common import Scratch, fresh, read
from tradeflow.llm.exact import drop_exact_copies
from tradeflow.llm.mixing import mix_sources
from tradeflow.llm.setsketch import drop_near_copies
from tradeflow.llm.toxicity import fit, toxicity_score

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
REJECTED = 0.5
PLACE = ["mix_slot", "mix_position"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model learns from the table ``labels``."""
    model = fit(docs, read(spark, sf_dir, "labels"))
    (score,) = fresh(docs, "toxicity_score")
    scored = docs.withColumn(score, toxicity_score(docs, F.col("text"), model))
    return scored.filter(F.col(score) < REJECTED).select(docs.columns)


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for blanks, the longest; then the smallest id."""
    return drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 on five-word shingles, the smallest id."""
    return drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: sources weigh as their size to the 0.7.

    A scan of several files does not keep the order, so slot and position stay as columns;
    they take a leading underscore where documents have such columns.
    """
    slot, position = fresh(docs, *PLACE)
    return mix_sources(docs).orderBy(position).select(*docs.columns, slot, position)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and its place in the mix; null without a mix.

    Of several columns named like a place, the mix's is the one with most underscores.
    """
    tokens = encode_texts(docs, F.col("text"), TOKENIZER)
    named = [[c for c in docs.columns if c.lstrip("_") == name] for name in PLACE]
    place = [
        (F.col(max(found, key=len)) if found else F.lit(None).cast("long")).alias(name)
        for name, found in zip(PLACE, named, strict=True)
    ]
    return docs.select("doc_id", "source", "lang", *place, tokens.alias("t")).select(
        "doc_id", "source", "lang", *PLACE, "t.n_tokens", F.col("t.ids").alias("token_ids"),
        "t.ids_sha256", "t.decoded_sha256",
    )


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_exact_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("encoding", encoded),
]

# The model of the first stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table ``documents``, each result kept as Parquet in the folder
    of ``spark.checkpoint.dir`` until the next is written; the last stays. Rows come in
    the order of the mix."""
    docs = read(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    written: list[str] = []
    for name, stage in STAGES:
        docs = scratch.keep(name, stage(spark, docs, sf_dir))
        if written:
            scratch.drop(written[-1])
        written.append(name)
    return docs.orderBy("mix_position")
