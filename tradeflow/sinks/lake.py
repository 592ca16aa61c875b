"""The lake: JSON lines in folders by day and hour."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.functions.columns import ISO_MILLIS
from tradeflow.schema import PARTITIONS
from tradeflow.session import exists, scratch_folder
from tradeflow.sinks.spread import deal, spread

# Folder of each product below the lake path.
FOLDERS = {"bronze": "raw/hourly", "silver": "silver/hourly", "anomalies": "anomalies"}
REJECTS = "rejects"

COMPACT_BYTES = 256 * 1024 * 1024
RECORD = "_compacted"  # readers of the lake pass over names that start so
LISTING = "dt string, hour_bucket string, files long, bytes long"


def write_lake(
    df: DataFrame,
    path: str,
    *,
    shuffle: bool = True,
    rows_per_task: int | None = None,
    batch_id: int | None = None,
    run: str | None = None,
    max_records_per_file: int = 0,
    mode: str = "append",
    partitions: Sequence[str] = PARTITIONS,
) -> None:
    """Write a product that has ``dt`` and ``hour_bucket``, or other ``partitions``.

    A product with a ``value`` column is text already; others become JSON with
    millisecond ISO times and explicit nulls. With ``batch_id`` the rows go to a
    folder of that batch inside each hour, and a repeated batch replaces it; ``run``
    names the checkpoint that numbers the batches and keeps those of others apart.
    """
    out = spread(df, partitions, rows_per_task) if shuffle else df
    keys = list(partitions)
    if batch_id is not None:
        out, mode = out.withColumn("batch_id", F.lit(batch_id)), "overwrite"
        keys.append("batch_id")
        if run is not None:
            out = out.withColumn("run_id", F.lit(run))
            keys.insert(-1, "run_id")
    writer = (
        out.write.mode(mode)
        .partitionBy(*keys)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
    )
    if "value" in df.columns:
        writer.text(path)
    else:
        writer.option("timestampFormat", ISO_MILLIS).option("ignoreNullFields", "false").json(path)


def read_lake(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a product back with its declared schema, hours as two-digit text."""
    reader = spark.read.schema(schema).option("timestampFormat", ISO_MILLIS)
    df = reader.format("text" if "value" in schema.fieldNames() else "json").load(path)
    return df.select(schema.fieldNames())


def partition_manifest(
    lake: DataFrame, time_column: str, *, watermark_sec: int = 5, commit_delay_sec: int = 60
) -> DataFrame:
    """One row per hour: rows, time bounds, and whether it is complete.

    An hour is complete once the newest time of the whole table lies beyond its
    end by the watermark and commit delays.
    """
    hours = lake.groupBy(*PARTITIONS).agg(
        F.count("*").alias("row_count"),
        F.min(time_column).alias("min_time"),
        F.max(time_column).alias("max_time"),
    )
    # One task, but over hours, not rows: 24 a day.
    newest = F.max("max_time").over(Window.partitionBy())
    end = F.unix_seconds(F.date_trunc("hour", "min_time")) + 3600
    complete = F.unix_millis(newest) >= (end + watermark_sec + commit_delay_sec) * 1000
    return hours.withColumn("complete", F.coalesce(complete, F.lit(False)))


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes of each hour, from a distributed listing of the lake."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(path)
    )
    return (
        files.select(
            *(F.regexp_extract("path", rf"/{key}=([^/]+)/", 1).alias(key) for key in PARTITIONS),
            "length",
        )
        .groupBy(*PARTITIONS)
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


def compacted(spark: SparkSession, target: str) -> DataFrame:
    """What ``compact_partitions`` has written: each hour with the listing it was made of."""
    record = f"{target}/{RECORD}"
    if not exists(spark, record):
        return spark.createDataFrame([], LISTING)
    newest = Window.partitionBy(*PARTITIONS).orderBy(F.desc("run"))
    runs = spark.read.schema(f"{LISTING}, run long").parquet(record)
    return runs.withColumn("n", F.row_number().over(newest)).where("n = 1").drop("n", "run")


def compact_partitions(
    spark: SparkSession,
    path: str,
    target: str,
    schema: T.StructType,
    closed: DataFrame,
    *,
    file_bytes: int = COMPACT_BYTES,
) -> DataFrame:
    """Rewrite the ``closed`` hours of ``path`` below ``target`` in files of ``file_bytes``.

    Only hours whose files have changed since they were last written here are read: a
    record in the target names the files and bytes each hour was made of. Rows are dealt
    to the files of an hour in turn, so files are even however few tasks read them. The
    source is not touched. Returns the hours written, with files and bytes before.
    """
    listed = partition_files(spark, path).where("bytes > 0")
    wanted = listed.join(closed.select(*PARTITIONS), PARTITIONS, "left_semi")
    hours = wanted.join(compacted(spark, target), [*PARTITIONS, "files", "bytes"], "left_anti")
    # A small table, written so that what follows does not compute it again.
    kept = scratch_folder(spark, "compaction")
    hours.write.parquet(kept)
    hours = spark.read.schema(hours.schema).parquet(kept)
    if hours.isEmpty():
        return hours
    rows = read_lake(spark, path, schema).join(hours.select(*PARTITIONS), PARTITIONS, "left_semi")
    # Whole tasks for each hour, so that none of its files is cut short by another hour.
    pieces = F.ceil(F.col("bytes") / file_bytes)
    placed = deal(rows, PARTITIONS, hours.withColumn("size", pieces), 1)
    write_lake(placed, target, shuffle=False, mode="overwrite")
    run = F.lit(time.time_ns())
    hours.withColumn("run", run).coalesce(1).write.mode("append").parquet(f"{target}/{RECORD}")
    return hours
