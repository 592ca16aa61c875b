"""Lake and warehouse writers on batches."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import same_rows, trade, trades
from tradeflow.config import JdbcTarget
from tradeflow.operators.detect import anomalies
from tradeflow.operators.silver import anomalies_lake, bronze, silver_lake, to_silver
from tradeflow.schema import ANOMALY_LAKE, BRONZE_LAKE, PARTITIONS, SILVER_LAKE, SILVER_PUBLISHED
from tradeflow.sinks.lake import (
    compact_partitions,
    partition_files,
    partition_manifest,
    read_lake,
    write_lake,
)
from tradeflow.sinks.ledger import retried, write_once
from tradeflow.sinks.spread import spread
from tradeflow.sinks.warehouse import (
    LAYOUTS,
    arranged,
    jdbc_options,
    to_warehouse_types,
    write_warehouse,
)
from tradeflow.sources.events import read_events, trades_from_events
from tradeflow.sources.trades import parse_trades
from tradeflow.streaming.pipeline import TO_WAREHOUSE

HOUR = 3_600_000


@pytest.fixture(scope="module")
def raw(spark):
    # A few days: writing every hour of the month is slow.
    events = read_events(spark, "/root/testdata/sf0.001").where("ts < '2024-01-05'")
    cached = trades_from_events(events).persist()
    yield cached
    cached.unpersist()


@pytest.mark.parametrize("salt", [None, 300])
def test_lake_round_trip(spark, raw, tmp_path, salt):
    path = str(tmp_path)
    silver, findings = silver_lake(to_silver(raw)), anomalies_lake(anomalies(raw))
    write_lake(bronze(raw), f"{path}/b", rows_per_task=salt)
    write_lake(silver, f"{path}/s", rows_per_task=salt, shuffle=salt is None)
    write_lake(findings, f"{path}/a", rows_per_task=salt)
    assert same_rows(parse_trades(read_lake(spark, f"{path}/b", BRONZE_LAKE)), raw)
    assert same_rows(read_lake(spark, f"{path}/s", SILVER_LAKE), silver)
    assert same_rows(read_lake(spark, f"{path}/a", ANOMALY_LAKE), findings)
    assert glob.glob(f"{path}/s/dt=2024-01-01/hour_bucket=0?/part-*")


def test_times_are_iso_and_nulls_explicit(spark, tmp_path):
    row = trades(spark, [trade(1, is_maker=None)])
    write_lake(silver_lake(to_silver(row)), str(tmp_path))
    (file,) = glob.glob(f"{tmp_path}/dt=2024-01-01/hour_bucket=10/part-*")
    record = json.loads(open(file).read())
    assert record["event_time"] == "2024-01-01T10:00:00.001"
    assert record["is_maker"] is None


def test_a_repeated_batch_replaces_itself(spark, raw, tmp_path):
    silver = silver_lake(to_silver(raw))
    for batch_id in (0, 1, 1):
        write_lake(silver, f"{tmp_path}/lake", batch_id=batch_id, rows_per_task=500)
        write_warehouse(to_silver(raw).select(SILVER_PUBLISHED), "silver", str(tmp_path), batch_id=batch_id)
    assert same_rows(read_lake(spark, f"{tmp_path}/lake", SILVER_LAKE), silver.union(silver))
    assert spark.read.parquet(f"{tmp_path}/silver").count() == 2 * silver.count()


def hot_rows(spark):
    """Copies of one row, so that no content can tell them apart."""
    return spark.range(0, 40_000, 1, 8).selectExpr(
        "'x' AS value", "'2024-01-01' AS dt", "'10' AS hour_bucket"
    )


@pytest.mark.parametrize(
    "salt, settings",
    [
        # As in a stream.
        (5_000, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "2"}),
        # As in a batch, with a size that this little data exceeds.
        (None, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4000"}),
    ],
)
def test_a_hot_hour_is_written_by_several_tasks(spark, tmp_path, salt, settings):
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        write_lake(hot_rows(spark), str(tmp_path), rows_per_task=salt)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(glob.glob(f"{tmp_path}/dt=2024-01-01/hour_bucket=10/part-*")) > 2
    assert spark.read.text(str(tmp_path)).count() == 40_000


def test_manifest(spark):
    rows = [trade(0), trade(1), trade(HOUR), trade(2 * HOUR + 64_999)]
    manifest = partition_manifest(silver_lake(to_silver(trades(spark, rows))), "event_time")
    hours = {r.hour_bucket: (r.row_count, r.complete) for r in manifest.collect()}
    assert hours == {"10": (2, True), "11": (1, False), "12": (1, False)}
    rows.append(trade(2 * HOUR + 65_000))
    manifest = partition_manifest(silver_lake(to_silver(trades(spark, rows))), "event_time")
    assert {r.hour_bucket: r.complete for r in manifest.collect()}["11"]


def test_compaction(spark, raw, tmp_path):
    source, target = f"{tmp_path}/s", f"{tmp_path}/t"
    silver = silver_lake(to_silver(raw))
    for batch_id, part in enumerate(silver.randomSplit([1.0, 1.0, 1.0], seed=1)):
        write_lake(part, source, batch_id=batch_id, rows_per_task=300)
    lake = read_lake(spark, source, SILVER_LAKE)
    closed = partition_manifest(lake, "event_time").where("complete")
    first = compact_partitions(spark, source, target, SILVER_LAKE, closed)
    assert first.count() == closed.count()
    before = set(glob.glob(f"{target}/dt=*/*/part-*"))
    assert compact_partitions(spark, source, target, SILVER_LAKE, closed).count() == 0
    assert set(glob.glob(f"{target}/dt=*/*/part-*")) == before  # nothing was written again
    compacted = read_lake(spark, target, SILVER_LAKE)
    assert same_rows(compacted, lake.join(closed, PARTITIONS, "left_semi").select(SILVER_LAKE.fieldNames()))
    assert partition_files(spark, target).agg(F.max("files")).first()[0] == 1
    assert partition_files(spark, source).agg(F.max("files")).first()[0] > 1
    # Small target files: an hour is split over several.
    compact_partitions(spark, source, f"{tmp_path}/u", SILVER_LAKE, closed, file_bytes=2000)
    assert same_rows(read_lake(spark, f"{tmp_path}/u", SILVER_LAKE), compacted)
    # A late batch makes its hours due again, and only those.
    rows = compacted.count()
    late = silver.where("hour_bucket = '03'").limit(1)
    write_lake(late, source, batch_id=9, rows_per_task=300)
    again = compact_partitions(spark, source, target, SILVER_LAKE, closed)
    assert [r.hour_bucket for r in again.collect()] == ["03"]
    assert read_lake(spark, target, SILVER_LAKE).count() == rows + 1


@pytest.mark.parametrize("files", [1, 7])
def test_compacted_files_keep_their_size(spark, tmp_path, files):
    source, target = f"{tmp_path}/s", f"{tmp_path}/t"
    rows = spark.range(0, 30_000, 1, files).selectExpr(
        "concat('line ', id) AS value", "'2024-01-01' AS dt",
        "if(id % 3 = 0, '10', '11') AS hour_bucket",
    )
    write_lake(rows, source, shuffle=False)
    closed = rows.select(*PARTITIONS).distinct()
    compact_partitions(spark, source, target, BRONZE_LAKE, closed, file_bytes=40_000)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{target}/dt=*/*/part-*")]
    assert max(sizes) <= 60_000 and len(sizes) >= sum(sizes) / 60_000
    assert same_rows(read_lake(spark, target, BRONZE_LAKE), rows)


def test_a_hot_key_gets_tasks_in_proportion(spark):
    rows = spark.range(0, 11_000, 1, 4).selectExpr("id", "if(id < 1000, 'cold', 'hot') AS k")
    tasks = spread(rows, ["k"], 1000).withColumn("task", F.spark_partition_id())
    counts = {(r.k, r.task): r["count"] for r in tasks.groupBy("k", "task").count().collect()}
    assert sum(k == "hot" for k, _ in counts) == 10 and sum(k == "cold" for k, _ in counts) == 1
    assert max(counts.values()) <= 1100
    few = spread(rows.where("id % 100 = 0"), ["id"], 1000)  # many small keys share a task
    assert few.rdd.getNumPartitions() == 1
    assert spread(rows.limit(0), ["k"], 1000).count() == 0


def test_a_repeated_batch_is_not_appended_twice(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS x")
    written, waits = [], []
    state = {"failures": 2, "die": True}

    def append(part):
        if state["failures"]:
            state["failures"] -= 1
            raise OSError("no connection")
        if state["die"] and len(written) > 300:
            raise KeyboardInterrupt  # the driver ends here
        written.extend(r.id for r in part.collect())

    ledger = str(tmp_path / "ledger")
    with pytest.raises(KeyboardInterrupt):
        write_once(rows, append, ledger, rows_per_piece=200, sleep=waits.append)
    assert waits == [1.0, 2.0] and 300 < len(written) < 1000
    state["die"] = False
    assert 0 < write_once(rows.repartition(3), append, ledger, rows_per_piece=200) < 5
    assert write_once(rows, append, ledger, rows_per_piece=200) == 0
    assert sorted(written) == list(range(1000))


def test_retries_end(spark):
    waits = []

    def fail():
        raise OSError

    with pytest.raises(OSError):
        retried(fail, retries=3, sleep=waits.append)
    assert waits == [1.0, 2.0, 4.0]


def test_warehouse_types(spark):
    raw = trades(spark, [trade(0, symbol=None, price=None), trade(None, trade_id=1, qty="0")])
    rows = {r.trade_id: r for r in to_warehouse_types(anomalies(raw)).collect()}
    assert (rows[0].symbol, rows[0].price, rows[0].quantity) == ("", 0.0, 1.0)
    assert rows[1].window_start == dt.datetime(1970, 1, 1)
    flags = to_warehouse_types(to_silver(trades(spark, [trade(0, is_maker=True), trade(1, is_maker=None)])))
    assert sorted(r.is_maker for r in flags.collect()) == [0, 1]


def test_warehouse_layout(spark, raw, tmp_path):
    silver = to_silver(raw).select(SILVER_PUBLISHED)
    write_warehouse(silver, "silver", str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/silver")
    assert set(stored.columns) == {*SILVER_PUBLISHED, "ingest_time", "event_date"}
    assert same_rows(
        stored.selectExpr(*[c for c in SILVER_PUBLISHED if c != "is_maker"], "is_maker = 1 AS is_maker"), silver
    )
    assert os.path.isdir(f"{tmp_path}/silver/event_date=2024-01-01")
    parts = arranged(to_warehouse_types(silver), LAYOUTS["silver"]).rdd.glom().collect()
    keys = [[(r.event_date, r.symbol, r.trade_time) for r in part] for part in parts if part]
    assert all(part == sorted(part) for part in keys)


def test_jdbc_options():
    target = JdbcTarget(url="jdbc:x://h/db", user="u", password="p", driver="d")
    assert jdbc_options(target, "t", 3000) == {
        "url": "jdbc:x://h/db", "dbtable": "t", "user": "u", "password": "p", "batchsize": "3000",
        "driver": "d",
    }


def test_bronze_can_go_to_the_warehouse(spark, raw, tmp_path):
    rows = TO_WAREHOUSE["bronze"](raw)
    write_warehouse(rows, "bronze", str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/bronze")
    assert stored.count() == raw.count()
    assert set(stored.columns) == {*rows.columns, "event_date"}


def test_batches_of_another_run_stay(spark, tmp_path):
    rows = to_silver(trades(spark, [trade(i) for i in range(10)]))

    def write(n, run):
        part = rows.where(f"trade_id < {n}")
        write_lake(silver_lake(part), str(tmp_path / "lake"), batch_id=0, run=run)
        write_warehouse(part.select(SILVER_PUBLISHED), "silver", str(tmp_path), batch_id=0, run=run)

    write(10, "first")
    write(5, "second")
    write(3, "second")  # the same batch again
    assert spark.read.json(str(tmp_path / "lake")).count() == 13
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 13
