"""Every operator as a query over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.config import Thresholds
from tradeflow.operators import bars as b
from tradeflow.operators import detect as d
from tradeflow.operators.gaps import trade_gaps
from tradeflow.operators.reads import latest_trades, recent_anomalies
from tradeflow.operators.silver import anomalies_lake, bronze, silver_lake, to_silver
from tradeflow.schema import SILVER_PUBLISHED
from tradeflow.session import pin_utc
from tradeflow.sinks.lake import partition_manifest
from tradeflow.sinks.warehouse import LAYOUTS, arranged, to_warehouse_types
from tradeflow.sources.events import (
    envelopes_from_trades,
    messages_from_trades,
    read_events,
    stream_events,
    symbol_lines_from_events,
    trades_from_events,
)
from tradeflow.plans import written
from tradeflow.sources.trades import (
    judge_envelopes,
    parse_rejects,
    parse_trades,
    publish_trades,
    published,
    unwrap_envelope,
)
from tradeflow.sources.universe import (
    feed_by_shard,
    restrict_to_universe,
    stream_list,
    universe_from_lines,
)
from tradeflow.streaming.pipeline import stream_anomalies, stream_bars, stream_features
from tradeflow.streaming.replay import replay

Query = Callable[[SparkSession, str], DataFrame]

T0 = Thresholds()
KEYS = ["window_start", "window_end", "symbol"]


def without_zone(df: DataFrame) -> DataFrame:
    """Times as zone-free values, so that no session zone shifts a result."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp_ntz")
            for f in df.schema.fields
            if isinstance(f.dataType, T.TimestampType)
        }
    )


def _as_read(build: Query) -> Query:
    return lambda spark, sf_dir: without_zone(build(pin_utc(spark), sf_dir))


def _over_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: without_zone(build(read_events(pin_utc(spark), sf_dir)))


def _over_trades(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_events(lambda events: build(trades_from_events(events)))


def _over_silver(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_trades(lambda trades: build(to_silver(trades)))


def _over_bars(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_silver(lambda silver: build(b.bars(silver)))


def _replayed(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: without_zone(
        replay(
            pin_utc(spark), lambda session: trades_from_events(stream_events(session, sf_dir)), build
        )
    )


def _with_universe(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return _over_events(
        lambda events: build(
            trades_from_events(events), universe_from_lines(symbol_lines_from_events(events))
        )
    )


def _first_shard(trades: DataFrame, universe: DataFrame) -> DataFrame:
    return restrict_to_universe(trades, universe.where("shard = 1"))


def _published(trades: DataFrame) -> DataFrame:
    # The wire text and, parsed back from it, the id that identifies the row.
    return publish_trades(trades).select("value", F.get_json_object("value", "$.t").alias("trade_id"))


def _stream_gaps(trades: DataFrame) -> DataFrame:
    gap = d.intertrade_gap(T0, d.FIRST_TRADE, "previous_time")
    return d.emit(stream_features(to_silver(trades)), [gap])


QUERIES: dict[str, Query] = {
    # Sources
    "parse_trades": _over_trades(lambda t: parse_trades(publish_trades(t))),
    "event_time": _over_trades(lambda t: t.select("trade_id", "event_ms", "event_time")),
    "unwrap_envelope": _over_trades(lambda t: unwrap_envelope(envelopes_from_trades(t))[0]),
    "envelope_rejects": _over_trades(lambda t: unwrap_envelope(envelopes_from_trades(t))[1]),
    "parse_rejects": _over_trades(lambda t: parse_rejects(messages_from_trades(t))),
    "publish_envelope": _over_trades(lambda t: published(judge_envelopes(envelopes_from_trades(t)))),
    "subscriptions": _over_events(
        lambda e: stream_list(universe_from_lines(symbol_lines_from_events(e)))
    ),
    "symbol_universe": _over_events(lambda e: universe_from_lines(symbol_lines_from_events(e))),
    "universe_filter": _with_universe(_first_shard),
    "feed_union": _with_universe(feed_by_shard),
    "publish_value": _over_trades(_published),
    # Silver and what the sinks receive
    "bronze": _over_trades(bronze),
    "silver": _over_trades(to_silver),
    "silver_lake": _over_silver(silver_lake),
    "silver_warehouse": _over_silver(lambda s: to_warehouse_types(s.select(SILVER_PUBLISHED))),
    "warehouse_layout": _over_silver(
        lambda s: arranged(to_warehouse_types(s.select(SILVER_PUBLISHED)), LAYOUTS["silver"])
    ),
    "partition_manifest": _over_silver(lambda s: partition_manifest(silver_lake(s), "event_time")),
    # What readers find of what was written
    "lake_written": _as_read(written.lake_written),
    "lake_batches": _as_read(written.lake_batches),
    "lake_compacted": _as_read(written.lake_compacted),
    "warehouse_written": _as_read(written.warehouse_written),
    "warehouse_bronze": _as_read(written.warehouse_bronze),
    "pipeline_landed": _as_read(written.pipeline_landed),
    "pipeline_routed": _as_read(written.pipeline_routed),
    # Windows
    "tumble_5m": _over_silver(lambda s: b.windowed(s, b.BAR).select("trade_id", *KEYS)),
    "tumble_5s": _over_silver(lambda s: b.windowed(s, b.BURST).select("trade_id", *KEYS)),
    "stats_5m": _over_silver(
        lambda s: b.summarise(s, b.BAR).select(
            *KEYS, "low", "high", "volume", "trade_count", "sell_volume", "buy_volume"
        )
    ),
    "buy_sell_volume": _over_bars(lambda x: x.select(*KEYS, "buy_volume", "sell_volume")),
    "open_5m": _over_bars(lambda x: x.select(*KEYS, "open_price")),
    "close_5m": _over_bars(lambda x: x.select(*KEYS, "close_price")),
    "open_rank": _over_silver(lambda s: b.extreme_by_rank(s, "open_price")),
    "close_rank": _over_silver(lambda s: b.extreme_by_rank(s, "close_price", last=True)),
    "ohlcv_5m": _over_silver(b.bars),
    "ohlcv_join": _over_silver(b.bars_by_join),
    "burst_5s": _over_silver(b.bursts),
    # Features
    "bar_features": _over_bars(b.bar_features),
    "pct_change": _over_bars(lambda x: b.price_features(x).select(*KEYS, "pct_change")),
    "range_pct": _over_bars(lambda x: b.price_features(x).select(*KEYS, "range_pct")),
    "avg_vol_20": _over_bars(lambda x: b.with_avg_volume(x).select(*KEYS, "volume", "avg_vol_20")),
    "intertrade_lag": _over_silver(trade_gaps),
    # Detectors
    "price_spike_up": _over_bars(lambda x: d.emit(b.price_features(x), [d.price_spike_up(T0)])),
    "price_spike_down": _over_bars(lambda x: d.emit(b.price_features(x), [d.price_spike_down(T0)])),
    "volatility_spike": _over_bars(lambda x: d.emit(b.price_features(x), [d.volatility_spike(T0)])),
    "volume_spike": _over_bars(lambda x: d.emit(b.with_avg_volume(x), [d.volume_spike(T0)])),
    "intertrade_gap": _over_silver(d.gap_anomalies),
    "burst_of_trades": _over_silver(lambda s: d.emit(b.bursts(s), [d.burst_of_trades(T0)])),
    "data_quality": _over_trades(d.data_quality),
    "anomalies": _over_trades(d.anomalies),
    "anomalies_lake": _over_trades(lambda t: anomalies_lake(d.anomalies(t))),
    "anomalies_warehouse": _over_trades(lambda t: to_warehouse_types(d.anomalies(t))),
    # Reports
    "latest_trades": _over_silver(latest_trades),
    "recent_anomalies": _over_trades(lambda t: recent_anomalies(d.anomalies(t))),
    # Streams, replayed to their end
    "stream_bars": _replayed(lambda t: stream_bars(to_silver(t))),
    "stream_gaps": _replayed(_stream_gaps),
    "stream_anomalies": _replayed(stream_anomalies),
}
