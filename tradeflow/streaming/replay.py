"""Run a streaming operator over a finished table and return all its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.schema import TRADE
from tradeflow.session import STATE_STORE, pin_utc, scratch_folder

FLUSH = "__FLUSH__"
FAR_FUTURE_MS = 4_102_444_800_000  # 2100-01-01

TIMED_TRADE = T.StructType([*TRADE.fields, T.StructField("event_time", T.TimestampType())])


def _sentinel(spark: SparkSession) -> DataFrame:
    """One trade so late that every open window closes."""
    return spark.range(1).select(
        F.lit("trade").alias("event_kind"),
        F.lit(FAR_FUTURE_MS).alias("event_ms"),
        F.lit(FLUSH).alias("symbol"),
        F.lit(0).cast("long").alias("trade_id"),
        F.lit("1").alias("price"),
        F.lit("1").alias("qty"),
        F.lit(FAR_FUTURE_MS).alias("trade_ms"),
        F.lit(True).alias("is_maker"),
        F.lit(True).alias("ignore_flag"),
        F.timestamp_millis(F.lit(FAR_FUTURE_MS)).alias("event_time"),
    )


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for streams.

    Its state partitions are those of the caller's setting, whatever cores are
    there at that moment: the layout of a state outlives its first start.
    """
    session = pin_utc(spark.newSession())
    for key, value in STATE_STORE.items():
        session.conf.set(key, value)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    return session


def replay(
    spark: SparkSession,
    source: Callable[[SparkSession], DataFrame],
    operator: Callable[[DataFrame], DataFrame],
    *,
    watermark: str = "5 seconds",
) -> DataFrame:
    """``operator`` over the stream of raw trades that ``source`` opens.

    The stream runs over what is there; then one far-future trade arrives, and
    it runs again from its checkpoint to close the last windows.
    """
    folder = scratch_folder(spark, "replay")
    session = stream_session(spark)
    sentinels = f"{folder}/sentinel"
    _sentinel(session).limit(0).write.parquet(sentinels)

    late = session.readStream.schema(TIMED_TRADE).parquet(sentinels)
    trades = source(session).unionByName(late).withWatermark("event_time", watermark)
    result = operator(trades)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/result/batch={batch_id}")

    def run() -> None:
        (
            result.writeStream.outputMode("append")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
            .awaitTermination()
        )

    run()
    _sentinel(session).write.mode("append").parquet(sentinels)
    run()
    rows = spark.read.schema(result.schema).parquet(f"{folder}/result")
    return rows.select(result.columns).where(F.col("symbol").isNull() | (F.col("symbol") != FLUSH))
