"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import functools
import os
import shutil
import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.session import scratch_folder

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ARROW_BYTES = 8 << 20
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Also bounds the batches that the session sends them: by their size, as one text
    may be as long as thousands of others. Shuffle files go when the result they
    served is written, so an operator of many steps holds those of one at a time.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    context = spark.sparkContext
    if context.applicationId in _shipped or not os.path.isdir(PACKAGE):
        return
    folder = tempfile.mkdtemp(prefix="tradeflow-code-")  # executors fetch it from the driver
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(
        os.path.join(folder, "tradeflow_workers"),
        "zip",
        os.path.dirname(PACKAGE),
        os.path.basename(PACKAGE),
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def tidy(work):
    """A function over batches that gives freed memory back when its task ends.

    Workers live on for the next task, beside a heap that is sized for the executor;
    what the allocators of numpy and Arrow hold in reserve would add up.
    """

    @functools.wraps(work)
    def tidied(batches):
        try:
            yield from work(batches)
        finally:
            import pyarrow

            pyarrow.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return tidied


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage there.

    The folder is ``spark.checkpoint.dir`` of the session. Only a local master
    may go without one: it gets a temporary folder.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tradeflow-checkpoints-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


class Scratch:
    """Compressed intermediate tables in the shared folder, gone when the block ends.

    What is returned from the block must not read them any more.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.folder = scratch_folder(spark, purpose)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` as a table and read it from there."""
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads; without names, the whole folder."""
        for name in names or ("",):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        self.drop()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    result = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        result.append(name)
    return result


def shielded(docs: DataFrame, results: Sequence[str], work, **columns: str) -> DataFrame:
    """The rows that ``work`` keeps of ``docs``, with the columns of ``docs`` as they were.

    Columns named like one of the ``results`` that ``work`` adds stand aside meanwhile;
    ``columns`` are the names that ``work`` is told to read, which stay.
    """
    clashing = [c for c in docs.columns if c.lower() in results and c not in columns.values()]
    aside = dict(zip(clashing, fresh(docs, *(f"own_{c}" for c in clashing)), strict=True))
    found = work(docs.withColumnsRenamed(aside))
    return found.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))


def order_key(hashed: Column) -> Column:
    """The hash as a number from 0 to 2^64 - 1, for sums that cannot overflow."""
    return hashed.cast("decimal(38,0)")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every id in ``links`` (a, b): its smallest reachable id.

    Alternates the two star operations (every larger neighbour moves to a node's
    smallest neighbour; then every smaller one does) until nothing changes, so
    paths shorten by a constant factor each round. Aggregates combine before the
    shuffle, and both join sides come from checkpoints, so Spark can split the
    links of a hub with very many neighbours. Links to null are ignored, as are
    links of a node to itself.
    """
    edges = checkpointed(
        links.select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct()
    )
    before = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(order_key(F.xxhash64("child", "parent")))
        ).first()
        if state == before:
            return edges.select(
                F.col("child").alias("node"), F.col("parent").alias("component")
            ).union(edges.select("parent", "parent").distinct())
        before = state
        both = edges.union(edges.select("parent", "child")).toDF("node", "other")
        least = checkpointed(
            both.groupBy("node").agg(F.min("other").alias("other")).select(
                F.col("node"), F.least("node", "other").alias("root")
            )
        )
        edges = (
            both.filter("other > node").join(least, "node")
            .select(F.col("other").alias("child"), F.col("root").alias("parent"))
            .distinct()
        )
        edges = checkpointed(edges)
        least = checkpointed(edges.groupBy("child").agg(F.min("parent").alias("root")))
        moved = edges.join(least, "child").select(
            F.col("parent").alias("child"), F.col("root").alias("parent")
        )
        edges = checkpointed(
            moved.filter("child <> parent")
            .union(least.select(F.col("child"), F.col("root")))
            .distinct()
        )
