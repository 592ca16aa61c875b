"""The running pipeline: parity with batch, late trades, restarts, routing."""

import dataclasses
import json
import math
import os
import shutil
import subprocess
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle

from helpers import BASE_MS, message, same_rows, trade, trades
from tradeflow.config import PipelineConfig
from tradeflow.operators.bars import bars
from tradeflow.operators.detect import anomalies
from tradeflow.operators.silver import anomalies_lake, silver_lake, to_silver
from tradeflow.schema import ANOMALY, ANOMALY_LAKE, BRONZE_LAKE, SILVER_LAKE
from tradeflow.sinks.lake import FOLDERS, REJECTS, read_lake
from tradeflow.sources.trades import judge_messages, parse_trades, read_messages, read_trades
from tradeflow.streaming.pipeline import (
    checkpoint_root,
    configure,
    run_pipeline,
    start_pipeline,
    start_publisher,
    stream_bars,
    stream_features,
)
from tradeflow.streaming.replay import FAR_FUTURE_MS, FLUSH, replay, stream_session
from tradeflow.streaming.state import FEATURES, WINDOW, BarProcessor, BarSet, FramedBars

MINUTE = 60_000
FLUSH_ROW = trade(FAR_FUTURE_MS - BASE_MS, symbol=FLUSH)


def put(folder, name, rows, when):
    """One file of messages; files are read in the order of their times."""
    path = folder / f"{name}.txt"
    path.write_text("\n".join(message(r) for r in rows) + "\n")
    os.utime(path, (when, when))


@pytest.fixture
def config(tmp_path):
    (tmp_path / "in").mkdir()
    return PipelineConfig(
        source_path=str(tmp_path / "in"),
        max_files_per_trigger=1,
        sink_target="both",
        lake_path=str(tmp_path / "lake"),
        warehouse_path=str(tmp_path / "warehouse"),
        checkpoint_root=str(tmp_path / "checkpoints"),
        trigger=None,
        state_partitions=2,
        rows_per_write_task=100,
    )


def history():
    """Bars over two hours, with spikes, a burst, gaps and bad rows."""
    first = [trade(i * 20_000, str(100 + i % 9), str(1 + i % 3), trade_id=i) for i in range(180)]
    second = [trade(2 * 3_600_000 + i * 50, qty="40", trade_id=1000 + i) for i in range(120)]
    second += [trade(2 * 3_600_000 + 9_000, price="-1", trade_id=2000, symbol="BBB")]
    second += [trade(2 * 3_600_000 + 10_000, symbol=None, trade_id=2001)]
    return first, second


def test_restart_writes_everything_once_to_both_targets(spark, config, tmp_path):
    session = stream_session(spark)
    folder, (first, second) = tmp_path / "in", history()
    put(folder, "a", first, 1000)
    run_pipeline(session, config)
    put(folder, "b", second, 2000)
    put(folder, "c", [FLUSH_ROW], 3000)
    run_pipeline(session, config)

    raw = trades(spark, first + second)
    kept = f"symbol IS NULL OR symbol <> '{FLUSH}'"
    lake = {
        name: read_lake(spark, f"{config.lake_path}/{FOLDERS[name]}", schema)
        for name, schema in (("bronze", BRONZE_LAKE), ("silver", SILVER_LAKE), ("anomalies", ANOMALY_LAKE))
    }
    assert same_rows(parse_trades(lake["bronze"]).where(kept), raw)
    assert same_rows(lake["silver"].where(kept), silver_lake(to_silver(raw)))
    expected = anomalies_lake(anomalies(raw))
    assert {r.anomaly_type for r in expected.collect()} >= {
        "price_spike_up_5m", "volatility_spike_5m", "volume_spike_5m", "intertrade_gap",
        "burst_of_trades", "data_quality",
    }
    assert same_rows(lake["anomalies"].where(kept), expected)

    stored = spark.read.parquet(f"{config.warehouse_path}/anomalies").where(f"symbol <> '{FLUSH}'")
    assert stored.count() == expected.count()
    assert spark.read.parquet(f"{config.warehouse_path}/silver").count() == lake["silver"].count()
    assert not os.path.exists(f"{config.warehouse_path}/bronze")
    assert set(ANOMALY.fieldNames()) <= set(stored.columns)


def test_anomalies_use_two_stateful_operators(spark, config, tmp_path):
    put(tmp_path / "in", "a", [trade(0)], 1000)
    queries = start_pipeline(stream_session(spark), config)
    for query in queries.values():
        query.awaitTermination()
    assert set(queries) == {"landing", "anomalies"}
    assert len(queries["anomalies"].lastProgress.stateOperators) == 2
    assert not queries["landing"].lastProgress.stateOperators


def test_every_message_lands_as_bronze_or_as_a_reject(spark, config, tmp_path):
    good = [message(trade(1)), '{"x":{"y":[1, 2]}, ' + message(trade(2))[1:] + "  ", "{}",
            message(trade(None, trade_id=3))]
    bad = ["{broken", "", "[]", '"text"', "{broken"]
    (tmp_path / "in" / "a.txt").write_text("\n".join(good + bad) + "\n")
    run_pipeline(stream_session(spark), dataclasses.replace(config, sink_target="lake"))
    bronze = [json.loads(r.value) for r in read_lake(spark, f"{config.lake_path}/{FOLDERS['bronze']}", BRONZE_LAKE).collect()]
    kept = {r.get("t"): r for r in bronze}
    assert len(bronze) == len(good) and kept[2]["x"] == {"y": [1, 2]}
    assert kept[1]["ts"] == "2024-01-01T10:00:00.001" and kept[3]["ts"] is None
    lost = spark.read.json(f"{config.lake_path}/{REJECTS}")
    assert sorted(lost.collect(), key=str)[0].reason == "bad_json"
    assert sorted(r.message for r in lost.collect()) == sorted(bad)


def test_a_backlog_is_read_in_parts_by_default(spark, config, tmp_path):
    default = PipelineConfig().max_files_per_trigger
    for i in range(100):
        put(tmp_path / "in", f"f{i}", [trade(i)], 1000 + i)
    cfg = dataclasses.replace(config, max_files_per_trigger=default)
    judged = judge_messages(read_messages(stream_session(spark), cfg))
    counts = []
    (
        judged.writeStream.option("checkpointLocation", f"{tmp_path}/c")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, n: counts.append(batch.count()))
        .start()
        .awaitTermination()
    )
    assert len(counts) >= 4 and sum(counts) == 100 and max(counts) <= default


def test_a_failing_stream_ends_the_others(spark, config, tmp_path):
    put(tmp_path / "in", "a", [trade(0)], 1000)
    cfg = dataclasses.replace(config, lake_path="nowhere://x", sink_target="lake")
    session = stream_session(spark)
    with pytest.raises(Exception):  # noqa: B017
        run_pipeline(session, cfg)
    assert not session.streams.active


def test_checkpoint_root_is_shared_and_absolute(spark, config):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark, PipelineConfig()) == f"{shared}/tradeflow-streams"
    with pytest.raises(ValueError):
        checkpoint_root(spark, PipelineConfig(checkpoint_root="checkpoints"))


def test_state_can_be_read_and_moved(spark, config, tmp_path):
    """The volumes in the state are those of batch, and a moved checkpoint goes on."""
    folder, (first, second) = tmp_path / "in", history()
    put(folder, "a", first, 1000)
    put(folder, "b", second[:50], 2000)
    session = stream_session(spark)
    run_pipeline(session, config)
    state = session.read.format("statestore").option("path", f"{config.checkpoint_root}/anomalies")
    state = state.option("operatorId", 0).option("stateVarName", "past").load()
    volumes = {r.key[0]: r.value.volumes for r in state.collect()}
    closed = bars(to_silver(trades(spark, first))).orderBy("window_start").collect()
    assert volumes["AAA"] == [r.volume for r in closed][-20:]

    moved = dataclasses.replace(config, checkpoint_root=str(tmp_path / "moved"))
    shutil.copytree(config.checkpoint_root, moved.checkpoint_root)
    put(folder, "c", second[50:], 3000)
    put(folder, "d", [FLUSH_ROW], 4000)
    run_pipeline(session, moved)
    found = read_lake(spark, f"{config.lake_path}/{FOLDERS['anomalies']}", ANOMALY_LAKE)
    expected = anomalies_lake(anomalies(trades(spark, first + second)))
    assert same_rows(found.where(f"symbol IS NULL OR symbol <> '{FLUSH}'"), expected)


def test_a_bar_closes_by_its_timer_when_its_symbol_falls_silent(spark, config, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a", [trade(0), trade(1_000)], 1000)
    put(folder, "b", [trade(30_000, symbol="BBB")], 2000)  # closes the window, not the bar
    put(folder, "c", [trade(40_000, symbol="BBB")], 3000)
    put(folder, "d", [trade(20 * MINUTE, symbol="BBB")], 4000)
    put(folder, "e", [trade(20 * MINUTE + 1, symbol="BBB")], 5000)
    session = configure(stream_session(spark), config)
    result = f"{tmp_path}/bars"
    (
        stream_bars(to_silver(read_trades(session, config)))
        .writeStream.option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{result}/batch={n}"))
        .start()
        .awaitTermination()
    )
    found = {r.symbol: r.trade_count for r in spark.read.parquet(result).collect()}
    assert found == {"AAA": 2, "BBB": 2}


class FakeState:
    """The state of one key in memory, counting what is held in it."""

    def __init__(self):
        self.bars, self.value, self.timers = {}, None, []

    def getMapState(self, *_):  # noqa: N802
        return self

    def getValueState(self, *_):  # noqa: N802
        outer = self

        class Value:
            def get(self):
                return outer.value

            def update(self, value):
                outer.value = value

        return Value()

    def registerTimer(self, when):  # noqa: N802
        self.timers.append(when)

    def keys(self):
        return iter(list(self.bars))

    def getValue(self, key):  # noqa: N802
        return self.bars[key]

    def updateValue(self, key, value):  # noqa: N802
        self.bars[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.bars[key]

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.watermark


def test_a_long_backlog_of_one_symbol_is_held_in_the_state(monkeypatch):
    """500,000 windows in any order: memory holds 20,000, and the bars are right."""
    held = []
    keep = BarProcessor._keep
    monkeypatch.setattr(
        BarProcessor, "_keep",
        lambda self, bars, stored: (held.append(sum(map(len, bars.values()))), keep(self, bars, stored))[1],
    )
    state = FakeState()
    processor = BarProcessor(20, 300, 5, 60_000, held=20_000)
    processor.init(state)
    n = 500_000
    starts = [(i * 7919 % n) * 5_000_000 for i in range(n)]
    rows = (
        dict(zip(WINDOW.fieldNames(), (s, 1.0, 2.0, s / 5e6, 1, 1.0, 0.0, s, s, 1.5, 1.0, s + 1, 1.6), strict=True))
        for s in starts
    )
    state.watermark = (n - 10) * 5_000  # the last bar is open
    found = [r for r in processor.handleInputRows(("A",), rows, state) if r.burst_start is None]
    assert len(found) == n // 60 and max(held) <= 20_000
    assert [r.window_start for r in found] == [k * 300_000_000 for k in range(len(found))]
    volumes = [sum(range(k * 60, k * 60 + 60)) for k in range(len(found))]
    assert [r.volume for r in found] == volumes
    assert found[-1].avg_vol_20 == sum(volumes[-20:]) / 20
    assert all(b.previous_time == a.last_time for a, b in zip(found, found[1:], strict=False))
    assert [len(v[0]) for v in state.bars.values()] == [n - n // 60 * 60]
    assert state.timers == [(len(found) + 1) * 300_000]  # the end of the open bar
    state.watermark = n * 5_000 + 300_000
    (last,) = processor.handleExpiredTimer(("A",), state, None)
    assert last.trade_count == n - n // 60 * 60 and not state.bars


def window(start, trade_id, number=1.0):
    values = (start, 1.0, 2.0, number, 1, 1.0, 0.0, start, trade_id, 1.5, 1.0, start + 1, 1.6)
    return dict(zip(WINDOW.fieldNames(), values, strict=True))


def test_what_a_symbol_returns_leaves_in_bounded_frames():
    """Output goes on while input is still to be read, in frames of at most ``rows`` rows."""
    n, read = 5_000, []

    def frames():
        for begin in range(0, n, 100):
            read.append(begin)
            ids = [None if k % 2 else str(2**62 + k) for k in range(begin, begin + 100)]
            starts = range(begin * 5_000_000, (begin + 100) * 5_000_000, 5_000_000)
            yield pd.DataFrame([window(s, i) for s, i in zip(starts, ids, strict=True)])

    state = FakeState()
    state.watermark = n * 5_000 + 300_000
    processor = FramedBars(BarProcessor(20, 300, 5, 60_000), rows=250)
    processor.init(state)
    found = processor.handleInputRows(("A",), frames(), state)
    first = next(found)
    assert len(read) <= 4 and list(first.columns) == FEATURES.fieldNames()
    assert first.first_id.tolist() == [None if k % 2 else 2**62 + k for k in range(250)]
    rest = list(found)
    assert max(map(len, rest)) <= 250
    bars_found = [r for f in rest for r in f.itertuples() if r.burst_start is None]
    assert sum(len(f) for f in rest) + 250 == n + len(bars_found)
    assert [r.window_start for r in bars_found] == [k * 300_000_000 for k in range(-(-n // 60))]


def test_streamed_windows_keep_missing_ids_whole_numbers_and_nan(spark, tmp_path):
    huge = "1.7E308"
    rows = [trade(0, qty=huge, trade_id=2**62 + 1), trade(1, qty=huge, trade_id=2**62 + 2),
            trade(6_000, qty="-" + huge, trade_id=3), trade(6_001, qty="-" + huge, trade_id=4),
            trade(20_000, symbol="BBB", trade_id=2**62 + 5)]
    rows.append(("trade", BASE_MS, "CCC", None, "7", "1", BASE_MS, False, True))
    raw = trades(spark, rows)
    raw.write.parquet(f"{tmp_path}/in")
    features = replay(
        spark,
        lambda session: session.readStream.schema(raw.schema).parquet(f"{tmp_path}/in"),
        lambda t: stream_features(to_silver(t)),
    ).collect()
    ids = {(r.symbol, r.window_start, r.burst_start is None): r.first_id for r in features}
    assert sorted(map(str, ids.values())) == sorted(
        [str(2**62 + 1)] * 2 + ["3"] + [str(2**62 + 5)] * 2 + ["None"] * 2
    )
    bar = {r.symbol: r for r in features if r.burst_start is None}["AAA"]
    assert math.isnan(bar.volume) and math.isnan(bar.avg_vol_20) and bar.trade_count == 4
    assert all(r.avg_vol_20 is None for r in features if r.burst_start is not None)
    sums = sorted(r.volume for r in features if r.burst_start is not None and r.symbol == "AAA")
    assert sums == [-math.inf, math.inf]


def test_open_bars_are_a_set_of_bits():
    starts = [k * k * 300 for k in range(-50, 2_000)]
    found = BarSet(300, reversed(starts))
    assert list(found) == sorted(set(starts)) and 300 in found and 600 not in found
    for start in starts[100:]:
        found.discard(start)
    assert list(found) == sorted({s for s in starts[:100] if s not in set(starts[100:])})
    several = BarSet(300, range(0, 300 * 1_000_000, 300))
    assert len(several.masks) < 1_000  # a thousand bars a number


def test_late_trades(spark, config, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a", [trade(0), trade(10_000), trade(7_000)], 1000)  # 3 s late, same file
    put(folder, "b", [trade(20 * MINUTE)], 2000)  # closes the first bar
    put(folder, "c", [trade(20 * MINUTE + 1)], 3000)
    put(folder, "d", [trade(30_000)], 4000)  # far too late
    put(folder, "e", [FLUSH_ROW], 5000)
    session = configure(stream_session(spark), config)
    result = f"{tmp_path}/bars"
    (
        bars(to_silver(read_trades(session, config)))
        .writeStream.option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{result}/batch={n}"))
        .start()
        .awaitTermination()
    )
    counts = {r.window_start: r.trade_count for r in spark.read.parquet(result).collect()}
    assert list(counts.values()) and sorted(counts.values()) == [2, 3]


def test_unknown_target_starts_nothing(spark, config):
    with pytest.raises(ValueError):
        start_pipeline(spark, dataclasses.replace(config, sink_target="nowhere"))
    assert not spark.streams.active


def test_publisher_passes_on_what_came_and_keeps_the_rest(spark, config, tmp_path):
    (tmp_path / "symbols.txt").write_text("aaa\n")
    rows = [trade(1), trade(2, symbol="BBB"), trade(3), trade(4, symbol=None)]
    names = ["aaa", "bbb", "AAA", "aaa"]
    lines = [
        '{"stream":"%s@trade","data":%s}' % (n, message(r)[:-1] + ', "new":{"a":[1]}}')
        for n, r in zip(names, rows, strict=True)
    ]
    bad = ["{broken", '{"stream":"aaa@trade"}', '{"stream":"aaa@trade","data":{}}',
           '{"stream":"aaa@trade","data":[1]}', lines[1]]
    (tmp_path / "in" / "a.txt").write_text("\n".join([lines[0], *lines[2:], *bad]))
    cfg = dataclasses.replace(config, symbol_files=(str(tmp_path / "symbols.txt"),))
    start_publisher(stream_session(spark), cfg, target=str(tmp_path / "out")).awaitTermination()
    text = spark.read.text(str(tmp_path / "out"))
    assert all(json.loads(r.value)["new"] == {"a": [1]} for r in text.collect())
    assert same_rows(parse_trades(text), trades(spark, [rows[0], *rows[2:]]))
    lost = {r.message: r.reason for r in spark.read.json(f"{config.lake_path}/{REJECTS}").collect()}
    reasons = ["bad_json", "no_data", "empty_data", "no_object", "not_subscribed"]
    assert lost == dict(zip(bad, reasons, strict=True))


def test_processors_need_no_package_on_the_workers(tmp_path):
    pickled = tmp_path / "processor"
    pickled.write_bytes(cloudpickle.dumps([BarProcessor(20, 300, 5, 60000)]))
    code = f"import pickle; print(pickle.load(open({str(pickled)!r}, 'rb'))[0].windows)"
    run = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True)
    assert run.stdout.strip() == "20", run.stderr
