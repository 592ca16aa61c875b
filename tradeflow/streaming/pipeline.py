"""The running pipeline: two streams, each computed once for all its targets."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tradeflow.config import LAKE, WAREHOUSE, PipelineConfig, Thresholds
from tradeflow.operators.bars import (
    BAR_COLUMNS,
    BAR_SEC,
    BURST,
    BURST_SEC,
    price_features,
    summarise,
    with_open_close,
)
from tradeflow.operators.detect import data_quality, window_anomalies
from tradeflow.operators.silver import anomalies_lake, bronze_text, silver_lake, to_silver
from tradeflow.schema import SILVER_PUBLISHED, TRADE
from tradeflow.session import STATE_STORE, exists, pin_utc
from tradeflow.sinks.lake import FOLDERS, REJECTS, write_lake
from tradeflow.sinks.warehouse import write_warehouse
from tradeflow.sources.trades import (
    good_trades,
    judge_envelopes,
    judge_messages,
    published,
    read_messages,
    read_trades,
    rejects,
)
from tradeflow.sources.universe import load_universe
from tradeflow.streaming.state import BarProcessor, with_bars_stream

def stream_features(silver: DataFrame, t: Thresholds | None = None) -> DataFrame:
    """Bars with features, five-second windows and gaps, as ``window_features`` in batch.

    Two stateful operators: the five-second aggregate, and the processor behind it.
    Windows come as soon as they are closed, bars and gaps at the end of the bar.
    """
    t = t or Thresholds()
    processor = BarProcessor(t.volume_windows, BAR_SEC, BURST_SEC, t.intertrade_gap.trigger)
    grains = summarise(silver, BURST)
    return price_features(with_open_close(with_bars_stream(grains, processor)))


def stream_bars(silver: DataFrame, t: Thresholds | None = None) -> DataFrame:
    features = stream_features(silver, t).where("burst_start IS NULL")
    return features.select(*BAR_COLUMNS, "pct_change", "range_pct", "avg_vol_20")


def stream_anomalies(trades: DataFrame, t: Thresholds | None = None) -> DataFrame:
    """All seven detectors over a stream of raw trades with a watermark."""
    t = t or Thresholds()
    windowed = window_anomalies(stream_features(to_silver(trades), t), t)
    return windowed.unionByName(data_quality(trades))


def configure(spark: SparkSession, cfg: PipelineConfig) -> SparkSession:
    """Session settings of the streams. The number of state partitions is fixed
    with the first start, because the state's layout depends on it."""
    pin_utc(spark)
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    if cfg.state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", cfg.state_partitions)
    return spark


# How each product leaves for the lake and for the warehouse. Bronze goes to the lake as
# the message came.
TO_LAKE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "silver": silver_lake,
    "anomalies": anomalies_lake,
}
TO_WAREHOUSE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "bronze": lambda df: df.select(*TRADE.fieldNames(), "event_time"),
    "silver": lambda df: df.select(SILVER_PUBLISHED),
    "anomalies": lambda df: df,
}


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """A name for all starts from one checkpoint, kept beside it.

    Batch ids count from 0 again under a new checkpoint; with this name in the
    folder of a batch they cannot replace an older run's. A start that broke off
    before the name was whole leaves none, and the next one makes it.
    """
    kept = f"{checkpoint}-run"
    if not exists(spark, f"{kept}/_SUCCESS"):
        new = spark.createDataFrame([(uuid.uuid4().hex,)], "value string")
        new.coalesce(1).write.mode("overwrite").text(kept)
    return spark.read.text(kept).first()[0]


def checkpoint_root(spark: SparkSession, cfg: PipelineConfig) -> str:
    """The folder of all checkpoints: the configured one, else one below the shared folder
    that the session names. A relative path would be another folder for each start."""
    root = cfg.checkpoint_root
    if root is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            raise ValueError("set checkpoint_root or spark.checkpoint.dir to a shared folder")
        root = f"{shared.rstrip('/')}/tradeflow-streams"
    if not (root.startswith("/") or ":/" in root):
        raise ValueError(f"checkpoint_root {root!r} must be an absolute path")
    return root


class Target:
    """Writes the products of one micro-batch to the lake, the warehouse or both.

    A batch that runs again after a failure replaces what it wrote before; batches
    of other runs stay.
    """

    def __init__(self, cfg: PipelineConfig, targets: set[str], run: str, batch_id: int, root: str):
        self.cfg, self.targets = cfg, targets
        self.run, self.batch_id, self.root = run, batch_id, root

    def lake(self, df: DataFrame, folder: str, **options) -> None:
        write_lake(
            df,
            f"{self.cfg.lake_path}/{folder}",
            rows_per_task=self.cfg.rows_per_write_task,
            batch_id=self.batch_id,
            run=self.run,
            max_records_per_file=self.cfg.max_records_per_file,
            **options,
        )

    def warehouse(self, df: DataFrame, product: str) -> None:
        cfg = self.cfg
        write_warehouse(
            TO_WAREHOUSE[product](df),
            product,
            cfg.warehouse_path,
            jdbc=cfg.jdbc,
            batch_rows=cfg.anomaly_batch_rows if product == "anomalies" else cfg.silver_batch_rows,
            batch_id=self.batch_id,
            run=self.run,
            rows_per_task=cfg.rows_per_write_task,
            retries=cfg.warehouse_retries,
            ledger=f"{self.root}/ledger",
        )

    def product(self, df: DataFrame, product: str) -> None:
        if LAKE in self.targets:
            self.lake(TO_LAKE[product](df), FOLDERS[product])
        if WAREHOUSE in self.targets:
            self.warehouse(df, product)


def land(judged: DataFrame, target: Target) -> None:
    """Bronze, silver and rejects of one batch of judged messages.

    Rejects go to the lake whatever the targets are: no message is lost.
    """
    trades = good_trades(judged)
    if LAKE in target.targets:
        target.lake(bronze_text(judged), FOLDERS["bronze"])
    if WAREHOUSE in target.targets and target.cfg.bronze_to_warehouse:
        target.warehouse(trades, "bronze")
    target.product(to_silver(trades), "silver")
    target.lake(rejects(judged), REJECTS, partitions=["reason"])


def _start(df: DataFrame, name: str, cfg: PipelineConfig, write) -> StreamingQuery:
    """Start a stream whose batches are computed once for all that ``write`` makes of them."""
    spark = df.sparkSession
    root = checkpoint_root(spark, cfg)
    checkpoint = f"{root}/{name}"
    run = run_id(spark, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(batch, Target(cfg, cfg.targets, run, batch_id, root))
        finally:
            batch.unpersist()

    writer = (
        df.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each)
    )
    if cfg.trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=cfg.trigger).start()


def start_pipeline(spark: SparkSession, cfg: PipelineConfig) -> dict[str, StreamingQuery]:
    """Start two streams: ``landing`` (bronze, silver, rejects) and ``anomalies``.

    Bronze goes to the lake only, unless the warehouse is asked for it. Raises
    ``ValueError`` for an unknown sink target, before anything starts.
    """
    _ = cfg.targets
    configure(spark, cfg)
    checkpoint_root(spark, cfg)
    judged = judge_messages(read_messages(spark, cfg))
    found = stream_anomalies(read_trades(spark, cfg), cfg.thresholds)
    return {
        "landing": _start(judged, "landing", cfg, land),
        "anomalies": _start(
            found, "anomalies", cfg, lambda batch, target: target.product(batch, "anomalies")
        ),
    }


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Run until stopped, or over what is available if there is no trigger.

    One failed or stopped stream ends the others, as they belong together.
    """
    queries = start_pipeline(spark, cfg)
    try:
        if cfg.trigger is not None:
            spark.streams.awaitAnyTermination()
        waiting = list(queries.values()) if cfg.trigger is None else []
        while waiting:
            for query in waiting:
                if query.awaitTermination(1):  # raises if it has failed
                    waiting = [q for q in waiting if q is not query]
    finally:
        for query in queries.values():
            query.stop()


def start_publisher(
    spark: SparkSession, cfg: PipelineConfig, target: str | None = None
) -> StreamingQuery:
    """Unwrap envelope messages from ``source_path`` and publish their data as it came.

    It goes to the Kafka topic, or as text files to the folder ``target``; what is not
    published goes to the rejects of the lake, with the reason.
    """
    if cfg.source_path is None:
        raise ValueError("the publisher reads envelope messages from source_path")
    pin_utc(spark)
    universe = None
    if cfg.symbol_files:
        universe = load_universe(spark, cfg.symbol_files, cfg.shard_size)

    def write(batch: DataFrame, to: Target) -> None:
        good = published(batch)
        if target is None:
            servers = {"kafka.bootstrap.servers": cfg.kafka_servers, "topic": cfg.kafka_topic}
            good.write.format("kafka").options(**servers).save()
        else:
            folder = f"{target}/run_id={to.run}/batch_id={to.batch_id}"
            good.write.mode("overwrite").text(folder)
        to.lake(rejects(batch), REJECTS, partitions=["reason"])

    return _start(judge_envelopes(read_messages(spark, cfg), universe), "publisher", cfg, write)
