"""Messages, envelopes and symbol lists."""

import json

import pytest

from helpers import message, same_rows, trade, trades
from tradeflow.config import PipelineConfig
from tradeflow.operators.silver import bronze
from tradeflow.sources.trades import (
    kafka_options,
    parse_rejects,
    parse_trades,
    publish_trades,
    union_feeds,
    unwrap_envelope,
)
from tradeflow.sources.universe import (
    feed_by_shard,
    load_universe,
    restrict_to_universe,
    stream_list,
)


def messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def envelope(row, **extra):
    return json.dumps({"stream": "aaa@trade", "data": json.loads(message(row)) | extra})


def test_unwrap(spark):
    good = [envelope(trade(1)), envelope(trade(2), extra={"deep": [1]}), envelope(trade(3, price=None))]
    bad = {
        '{"stream":': "bad_json", "": "bad_json", "[]": "bad_json", '"text"': "bad_json",
        '{"stream":"x"}': "no_data", '{"stream":"x","data":null}': "no_data", "{}": "no_data",
        '{"stream":"x","data":{}}': "empty_data",
    }
    kept, rejects = unwrap_envelope(messages(spark, [*good, *bad]))
    expected = trades(spark, [trade(1), trade(2), trade(3, price=None)])
    assert same_rows(kept, expected)
    assert {r.message: r.reason for r in rejects.collect()} == bad


def test_parse_keeps_fields_that_differ_by_case(spark):
    row = ("trade", 5, "AAA", 7, "1.5", "2", 4, True, False)
    parsed = parse_trades(messages(spark, [message(row), "{broken"]))
    assert [tuple(r)[:9] for r in parsed.collect()] == [row]
    assert [r.message for r in parse_rejects(messages(spark, [message(row), "{broken"])).collect()] == ["{broken"]


def test_binary_messages(spark):
    raw = messages(spark, [message(trade(1))]).selectExpr("CAST(value AS binary) AS value")
    assert same_rows(parse_trades(raw), trades(spark, [trade(1)]))


def test_published_and_bronze_text_read_back(spark):
    raw = trades(spark, [trade(1), trade(2, price=None, symbol=None), trade(None, trade_id=3)])
    assert same_rows(parse_trades(publish_trades(raw)), raw)
    assert same_rows(parse_trades(bronze(raw)), raw)
    lines = {json.loads(r.value)["t"]: json.loads(r.value) for r in bronze(raw).collect()}
    assert lines[1]["ts"] == "2024-01-01T10:00:00.001"
    assert lines[3]["ts"] is None and lines[3]["E"] is None


def test_symbol_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("  Btc \r\n\n\teth\nETH\n sol\n")
    (tmp_path / "b.txt").write_text("xrp")
    paths = [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")]
    universe = load_universe(spark, paths)
    listed = universe.orderBy("shard", "line_no").collect()
    assert [(r.shard, r.symbol) for r in listed] == [(1, "btc"), (1, "eth"), (1, "eth"), (1, "sol"), (2, "xrp")]
    streams = {r.shard: r.streams for r in stream_list(universe).collect()}
    assert streams == {1: "btc@trade/eth@trade/eth@trade/sol@trade", 2: "xrp@trade"}
    split = load_universe(spark, paths, shard_size=2).collect()
    assert sorted((r.shard, r.symbol) for r in split) == [
        (1, "btc"), (1, "eth"), (2, "xrp"), (3, "eth"), (3, "sol"),
    ]


def test_long_symbol_list_keeps_every_symbol(spark, tmp_path):
    (tmp_path / "long.txt").write_text("\n".join(f"s{i}" for i in range(2500)))
    universe = load_universe(spark, [str(tmp_path / "long.txt")])
    sizes = {r["shard"]: r["count"] for r in universe.groupBy("shard").count().collect()}
    assert sizes == {1: 1000, 2: 1000, 3: 500}
    raw = trades(spark, [trade(i, symbol=f"S{i}") for i in range(2500)])
    assert restrict_to_universe(raw, universe).count() == 2500


def test_empty_symbol_file_is_an_error(spark, tmp_path):
    (tmp_path / "none.txt").write_text("\n  \n")
    with pytest.raises(ValueError):
        load_universe(spark, [str(tmp_path / "none.txt")])


def test_feeds(spark, tmp_path):
    (tmp_path / "a.txt").write_text("aaa\nbbb\n")
    (tmp_path / "b.txt").write_text("bbb\nccc\n")
    universe = load_universe(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    raw = trades(spark, [trade(i, symbol=s) for i, s in enumerate(["AAA", "BBB", "CCC", "DDD", None])])
    kept = restrict_to_universe(raw, universe).collect()
    assert sorted(r.stream for r in kept) == ["aaa@trade", "bbb@trade", "ccc@trade"]
    shards = [
        restrict_to_universe(raw, universe.where(f"shard = {n}")).selectExpr("*", f"{n} AS shard")
        for n in (1, 2)
    ]
    assert same_rows(feed_by_shard(raw, universe), union_feeds(*shards))
    assert feed_by_shard(raw, universe).count() == 4


def test_environment():
    cfg = PipelineConfig.from_env(
        {"KAFKA_HOST": "k", "KAFKA_PORT": "1", "KAFKA_TOPIC": "t", "SINK_TARGET": "BOTH",
         "MINIO_BUCKET": "b", "CLICKHOUSE_HOST": "c", "SYMBOL_FILE_DIR": "x.txt"}
    )
    assert kafka_options(cfg) == {
        "kafka.bootstrap.servers": "k:1", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5000000",
    }
    bounded = PipelineConfig.from_env({"MAX_OFFSETS_PER_TRIGGER": "7", "MAX_FILES_PER_TRIGGER": "0"})
    assert kafka_options(bounded)["maxOffsetsPerTrigger"] == "7"
    assert bounded.max_files_per_trigger == 0
    assert cfg.targets == {"lake", "warehouse"}
    assert cfg.lake_path == "s3a://b"
    assert cfg.jdbc.url == "jdbc:clickhouse://c:8123/trading"
    assert PipelineConfig.from_env({}).targets == {"warehouse"}
