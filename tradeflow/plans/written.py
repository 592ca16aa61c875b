"""Queries that write through the sinks and return what a reader finds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.config import PipelineConfig
from tradeflow.operators.silver import silver_lake, to_silver
from tradeflow.schema import BRONZE_LAKE, SILVER_LAKE, SILVER_PUBLISHED
from tradeflow.session import pin_utc, scratch_folder
from tradeflow.sinks.lake import (
    FOLDERS,
    REJECTS,
    compact_partitions,
    partition_manifest,
    read_lake,
    write_lake,
)
from tradeflow.sinks.warehouse import write_warehouse
from tradeflow.sources.events import messages_from_trades, read_events, trades_from_events
from tradeflow.sources.trades import publish_trades
from tradeflow.streaming.pipeline import TO_WAREHOUSE, run_pipeline
from tradeflow.streaming.replay import stream_session


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(read_events(pin_utc(spark), sf_dir))


def lake_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver by hours, as a batch writes and reads it."""
    path = scratch_folder(spark, "lake")
    write_lake(silver_lake(to_silver(_raw(spark, sf_dir))), path)
    return read_lake(spark, path, SILVER_LAKE)


def _batches(spark: SparkSession, sf_dir: str) -> str:
    """A lake of three batches, of which one was written twice and one by another run."""
    path = scratch_folder(spark, "lake")
    silver = to_silver(_raw(spark, sf_dir))
    for batch_id, run in ((0, "a"), (1, "a"), (1, "a"), (0, "b")):
        kept = f"trade_id % 3 = {0 if run == 'b' else batch_id + 1}"
        part = silver_lake(silver.where(kept))
        write_lake(part, path, rows_per_task=5_000, batch_id=batch_id, run=run)
    return path


def lake_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lake(spark, _batches(spark, sf_dir), SILVER_LAKE)


def lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed hours of those batches, rewritten."""
    path, target = _batches(spark, sf_dir), scratch_folder(spark, "compacted")
    lake = read_lake(spark, path, SILVER_LAKE)
    closed = partition_manifest(lake, "event_time").where("complete")
    compact_partitions(spark, path, target, SILVER_LAKE, closed)
    return read_lake(spark, target, SILVER_LAKE)


def warehouse_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver in its warehouse table, and whether each row has its time of arrival."""
    path = scratch_folder(spark, "warehouse")
    write_warehouse(to_silver(_raw(spark, sf_dir)).select(SILVER_PUBLISHED), "silver", path)
    stored = spark.read.parquet(f"{path}/silver")
    return stored.withColumn("arrived", F.col("ingest_time").isNotNull()).drop("ingest_time")


def warehouse_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "warehouse")
    write_warehouse(TO_WAREHOUSE["bronze"](_raw(spark, sf_dir)), "bronze", path)
    return spark.read.parquet(f"{path}/bronze")


def _run(spark: SparkSession, sf_dir: str, messages, **settings) -> PipelineConfig:
    """The running pipeline over all trades as messages in files."""
    folder = scratch_folder(spark, "pipeline-run")
    messages(_raw(spark, sf_dir)).repartition(4).write.text(f"{folder}/in")
    cfg = PipelineConfig(
        source_path=f"{folder}/in",
        lake_path=f"{folder}/lake",
        warehouse_path=f"{folder}/warehouse",
        checkpoint_root=f"{folder}/checkpoints",
        trigger=None,
        **settings,
    )
    run_pipeline(stream_session(spark), cfg)
    return cfg


def pipeline_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the messages that one run of the pipeline read."""
    cfg = _run(spark, sf_dir, messages_from_trades, sink_target="lake")
    bronze = read_lake(spark, f"{cfg.lake_path}/{FOLDERS['bronze']}", BRONZE_LAKE)
    silver = read_lake(spark, f"{cfg.lake_path}/{FOLDERS['silver']}", SILVER_LAKE)
    lost = spark.read.schema("message string").json(f"{cfg.lake_path}/{REJECTS}")
    products = {"bronze": bronze, "silver": silver, "rejects": lost}
    counts = [
        df.agg(F.lit(name).alias("product"), F.count(F.lit(1)).alias("rows"))
        for name, df in products.items()
    ]
    return counts[0].union(counts[1]).union(counts[2])


def pipeline_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver in both targets of one run, by symbol."""
    cfg = _run(spark, sf_dir, publish_trades, sink_target="both")
    lake = read_lake(spark, f"{cfg.lake_path}/{FOLDERS['silver']}", SILVER_LAKE)
    stored = spark.read.parquet(f"{cfg.warehouse_path}/silver")
    by_target = [
        df.groupBy(F.lit(name).alias("target"), "symbol").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("volume")
        )
        for name, df in (("lake", lake), ("warehouse", stored))
    ]
    return by_target[0].union(by_target[1])
