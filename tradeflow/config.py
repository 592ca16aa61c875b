"""Thresholds of the detectors and settings of the pipeline."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Rule:
    """When a detector fires, what it reports as threshold, and how it grades.

    ``trigger`` and ``reported`` are separate because they differ for the two
    price spikes. ``None`` means the grade does not exist for that detector.
    """

    trigger: float
    reported: float
    high: float | None = None
    critical: float | None = None


@dataclass(frozen=True)
class Thresholds:
    # Default trigger, reported threshold and grade bounds.
    price_spike_up: Rule = Rule(trigger=2.5, reported=3.0, high=4.0, critical=6.0)
    price_spike_down: Rule = Rule(trigger=-2.5, reported=-3.0, high=-4.0, critical=-6.0)
    volatility_spike: Rule = Rule(trigger=5.0, reported=5.0, high=7.0, critical=10.0)
    volume_spike: Rule = Rule(trigger=3.0, reported=3.0, high=5.0, critical=8.0)
    intertrade_gap: Rule = Rule(trigger=60000, reported=60000.0, high=300000)
    burst_of_trades: Rule = Rule(trigger=50, reported=50.0, high=100, critical=200)
    volume_windows: int = 20


LAKE, WAREHOUSE, BOTH = "lake", "warehouse", "both"

# Accepted spellings of the sink target.
SINK_TARGETS = {
    "lake": {LAKE},
    "minio": {LAKE},
    "warehouse": {WAREHOUSE},
    "clickhouse": {WAREHOUSE},
    "both": {LAKE, WAREHOUSE},
}


@dataclass(frozen=True)
class JdbcTarget:
    """A warehouse reached over JDBC; its driver must be on the class path."""

    url: str
    user: str = "default"
    password: str = ""
    driver: str | None = None
    silver_table: str = "processed_trades"
    anomaly_table: str = "trade_anomalies"
    bronze_table: str = "raw_trades"


@dataclass(frozen=True)
class PipelineConfig:
    # Source: a Kafka topic, or a folder of text files with one message a line.
    kafka_servers: str = "localhost:9092"
    kafka_topic: str = "trades"
    # Bounds of one batch, so that a backlog is read in parts; 0 is no bound.
    max_offsets_per_trigger: int = 5_000_000
    source_path: str | None = None
    max_files_per_trigger: int = 32
    symbol_files: tuple[str, ...] = ()
    shard_size: int = 1000

    # Targets.
    sink_target: str = "warehouse"
    lake_path: str = "lake"
    warehouse_path: str = "warehouse"
    jdbc: JdbcTarget | None = None
    bronze_to_warehouse: bool = False
    silver_batch_rows: int = 10_000
    anomaly_batch_rows: int = 3_000
    warehouse_retries: int = 3
    max_records_per_file: int = 2_000_000
    rows_per_write_task: int = 500_000

    # Stream.
    checkpoint_root: str | None = None  # None: below spark.checkpoint.dir, which must be shared
    watermark: str = "5 seconds"
    trigger: str | None = "2 seconds"  # None runs once over what is available
    state_partitions: int | None = None

    thresholds: Thresholds = field(default_factory=Thresholds)

    @property
    def targets(self) -> set[str]:
        try:
            return SINK_TARGETS[self.sink_target.lower()]
        except KeyError:
            raise ValueError(
                f"sink target {self.sink_target!r} is none of {sorted(SINK_TARGETS)}"
            ) from None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> PipelineConfig:
        env = os.environ if env is None else env
        settings: dict = {
            "kafka_servers": f"{env.get('KAFKA_HOST', 'localhost')}:{env.get('KAFKA_PORT', '9092')}",
            "kafka_topic": env.get("KAFKA_TOPIC", cls.kafka_topic),
            "sink_target": env.get("SINK_TARGET", cls.sink_target).lower(),
        }
        if "LAKE_PATH" in env:
            settings["lake_path"] = env["LAKE_PATH"]
        elif "MINIO_BUCKET" in env:
            settings["lake_path"] = f"s3a://{env['MINIO_BUCKET']}"
        if "WAREHOUSE_PATH" in env:
            settings["warehouse_path"] = env["WAREHOUSE_PATH"]
        if "CHECKPOINT_ROOT" in env:
            settings["checkpoint_root"] = env["CHECKPOINT_ROOT"]
        for name in (
            "max_offsets_per_trigger", "max_files_per_trigger", "silver_batch_rows",
            "anomaly_batch_rows", "warehouse_retries", "rows_per_write_task",
        ):
            if name.upper() in env:
                settings[name] = int(env[name.upper()])
        if "SYMBOL_FILE_DIR" in env:
            settings["symbol_files"] = tuple(env["SYMBOL_FILE_DIR"].split(","))
        if "CLICKHOUSE_HOST" in env:
            host, port = env["CLICKHOUSE_HOST"], env.get("CLICKHOUSE_HTTP_PORT", "8123")
            settings["jdbc"] = JdbcTarget(
                url=f"jdbc:clickhouse://{host}:{port}/{env.get('CLICKHOUSE_DATABASE', 'trading')}",
                user=env.get("CLICKHOUSE_USER", JdbcTarget.user),
                password=env.get("CLICKHOUSE_PASSWORD", JdbcTarget.password),
                silver_table=env.get("CLICKHOUSE_SILVER_TABLE", JdbcTarget.silver_table),
                anomaly_table=env.get("CLICKHOUSE_ANOM_TABLE", JdbcTarget.anomaly_table),
                bronze_table=env.get("CLICKHOUSE_BRONZE_TABLE", JdbcTarget.bronze_table),
            )
        return cls(**settings)
