"""Detectors at the edges of their thresholds, on hand-written trades."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import bench
from helpers import BASE_MS, at, same_rows, trade, trades
from tradeflow.config import Rule, Thresholds
from tradeflow.operators import bars as b
from tradeflow.operators import detect as d
from tradeflow.operators.gaps import trade_gaps
from tradeflow.operators.silver import to_silver
from tradeflow.schema import ANOMALY

MINUTE = 60_000
BAR_MS = 5 * MINUTE


def found(df, kind):
    rows = df.where(F.col("anomaly_type") == kind).orderBy("window_start", "trade_id").collect()
    return [(r.window_start, r.severity, r.metric) for r in rows]


def bars_with_close(spark, closes, open_price="100"):
    rows = []
    for i, close in enumerate(closes):
        rows.append(trade(i * BAR_MS, open_price))
        rows.append(trade(i * BAR_MS + 1000, str(close)))
    return trades(spark, rows)


def test_price_spikes(spark):
    closes = [102.499, 102.5, 104, 106, 97.501, 97.5, 96, 94]
    result = d.anomalies(bars_with_close(spark, closes))
    up, down = found(result, "price_spike_up_5m"), found(result, "price_spike_down_5m")
    assert [(t, s) for t, s, _ in up] == [
        (at(BAR_MS), "MEDIUM"), (at(2 * BAR_MS), "HIGH"), (at(3 * BAR_MS), "CRITICAL"),
    ]
    assert [(t, s) for t, s, _ in down] == [
        (at(5 * BAR_MS), "MEDIUM"), (at(6 * BAR_MS), "HIGH"), (at(7 * BAR_MS), "CRITICAL"),
    ]
    spike = result.where("anomaly_type = 'price_spike_up_5m'").orderBy("window_start").first()
    assert (spike.threshold, spike.window_sec, spike.direction) == (3.0, 300, "UP")
    assert (spike.price, spike.quantity, spike.volume, spike.trade_count) == (102.5, 0.0, 2.0, 2)
    assert spike.trade_time == spike.window_end == at(2 * BAR_MS)
    assert spike.details == "Δ%=2.5"
    assert (spike.trade_id, spike.gap_ms) == (0, 0)


def test_volatility(spark):
    result = d.anomalies(bars_with_close(spark, [104.999, 105, 107, 110]))
    assert [s for _, s, _ in found(result, "volatility_spike_5m")] == ["MEDIUM", "HIGH", "CRITICAL"]


def test_zero_open_price_fires_nothing_on_price(spark):
    result = d.anomalies(bars_with_close(spark, [50], open_price="0"))
    assert {r.anomaly_type for r in result.collect()} == {"data_quality"}


def volume_history(spark, volumes, skipped=()):
    rows, slot = [], 0
    for volume in volumes:
        while slot in skipped:
            slot += 1
        rows.append(trade(slot * BAR_MS, qty=str(volume)))
        slot += 1
    return trades(spark, rows)


def test_volume_spike_grades_and_sliding_frame(spark):
    # 19 bars of 1 and one of v: ratio = 20 v / (19 + v)
    def ratio_of(volume):
        return 20 * volume / (19 + volume)

    for volume, grade in ((3.3, None), (3.4, "MEDIUM"), (6.4, "HIGH"), (12.7, "CRITICAL")):
        result = d.anomalies(volume_history(spark, [1] * 25 + [volume], skipped={3, 9}))
        spikes = found(result, "volume_spike_5m")
        assert [s for _, s, _ in spikes] == ([grade] if grade else []), volume
        if grade:
            assert spikes[0][2] == pytest.approx(ratio_of(volume))


def test_volume_spike_needs_three_windows(spark):
    # The mean includes the current bar, so the ratio is at most the bars seen.
    assert found(d.anomalies(volume_history(spark, [1, 1_000_000])), "volume_spike_5m") == []
    exact = d.anomalies(volume_history(spark, [0, 0, 9]))
    assert [m for _, _, m in found(exact, "volume_spike_5m")] == [3.0]


def test_gaps(spark):
    # Seconds are cut before they are subtracted: 59.999 s across a whole-second
    # edge counts as 60.
    cases = [
        ([0, 59_999], []),
        ([0, 60_000], [60_000]),
        ([500, 60_100], [60_000]),
        ([0, 300_000], [300_000]),
        ([0, 1_000, 299_000, 301_000], [298_000]),
        ([0, 1_000, 301_000, 301_500, 361_000], [300_000, 60_000]),
    ]
    for times, gaps in cases:
        result = d.anomalies(trades(spark, [trade(ms) for ms in times]))
        assert [m for _, _, m in found(result, "intertrade_gap")] == gaps, times
    row = d.anomalies(trades(spark, [trade(0), trade(300_000, "7", "2")])).first()
    assert (row.severity, row.window_sec, row.trade_id) == ("HIGH", 0, 300_000)
    assert (row.price, row.quantity, row.gap_ms, row.volume) == (7.0, 2.0, 300_000, 0.0)
    assert row.window_start == row.window_end == row.trade_time == at(300_000)
    assert row.details == "Gap ms=300000"


def test_gap_trigger_below_the_window_is_refused():
    with pytest.raises(ValueError):
        d.intertrade_gap(Thresholds(intertrade_gap=Rule(4000, 4000.0)), d.FIRST_TRADE, "p")


def burst(count, start=0):
    return [trade(start + i % 5000, trade_id=start + i) for i in range(count)]


def test_bursts(spark):
    cases = [(49, []), (50, ["MEDIUM"]), (99, ["MEDIUM"]), (100, ["HIGH"]), (199, ["HIGH"]),
             (200, ["CRITICAL"])]
    for count, grades in cases:
        result = d.anomalies(trades(spark, burst(count)))
        assert [s for _, s, _ in found(result, "burst_of_trades")] == grades, count
    split = trades(spark, [trade(4900 + i * 4, trade_id=i) for i in range(50)])
    assert found(d.anomalies(split), "burst_of_trades") == []


def test_data_quality(spark):
    bad = [
        trade(0, symbol=None), trade(1, price=None), trade(2, qty=None), trade(3, price="0"),
        trade(4, price="-1"), trade(5, qty="abc"), trade(6, price="NaN"), trade(7, qty=""),
        trade(8, price="Infinity"), trade(9, qty="-0"),
    ]
    raw = trades(spark, [*bad, trade(10), trade(None, qty="0", trade_id=11), trade(12, is_maker=None)])
    result = d.data_quality(raw)
    assert sorted(r.trade_id for r in result.collect()) == [*range(10), 11]
    assert result.schema.fieldNames() == ANOMALY.fieldNames()
    assert [f.dataType for f in result.schema] == [f.dataType for f in ANOMALY]
    # Silver keeps zero and negative numbers and drops what cannot be read.
    assert sorted(r.trade_id for r in to_silver(raw).collect()) == [3, 4, 9, 10, 11, 12]


def test_missing_maker_flag_is_on_neither_side(spark):
    raw = trades(spark, [trade(0, qty="1"), trade(1, qty="2", is_maker=True), trade(2, qty="4", is_maker=None)])
    bar = b.bars(to_silver(raw)).first()
    assert (bar.buy_volume, bar.sell_volume, bar.volume) == (1.0, 2.0, 7.0)


def test_ties_are_ordered_by_id(spark):
    raw = trades(spark, [trade(5, "3", trade_id=9), trade(5, "1", trade_id=2), trade(5, "2", trade_id=4)])
    bar = b.bars(to_silver(raw)).first()
    assert (bar.open_price, bar.close_price) == (1.0, 3.0)
    tick = trade_gaps(to_silver(raw)).collect()
    assert [(t.trade_id, t.gap_ms) for t in sorted(tick, key=lambda t: t.trade_id)] == [
        (2, None), (4, 0), (9, 0),
    ]


def test_rows_without_time_reach_no_window(spark):
    raw = trades(spark, [trade(None, trade_id=1), trade(0)])
    assert b.bars(to_silver(raw)).count() == 1
    assert trade_gaps(to_silver(raw)).count() == 1


@pytest.fixture(scope="module")
def skewed(spark):
    """One symbol, one burst and one repeated trade hold most of the rows."""
    hot = spark.range(30_000).selectExpr(
        "'HOT' AS symbol", "pmod(hash(id), 20000000) AS ms", "id AS trade_id", "100 + id % 13 AS p"
    )
    dense = spark.range(15_000).selectExpr("'HOT'", "3600000 + id % 4000", "id + 100000", "101")
    copies = spark.range(15_000).selectExpr("'HOT'", "7200000L", "7L", "102")
    rest = spark.range(3_000).selectExpr(
        "concat('S', id % 7)", "pmod(hash(id, 1), 20000000)", "id", "100 + id % 11"
    )
    rows = hot.union(dense).union(copies).union(rest)
    cached = rows.selectExpr(
        "'trade' AS event_kind", f"{BASE_MS}L + ms AS event_ms", "symbol", "trade_id",
        "CAST(p AS string) AS price", "CAST(1 + pmod(hash(ms), 5) AS string) AS qty",
        f"{BASE_MS}L + ms AS trade_ms", "ms % 2 = 0 AS is_maker", "true AS ignore_flag",
        f"timestamp_millis({BASE_MS}L + ms) AS event_time",
    ).persist()
    yield cached
    cached.unpersist()


def test_skew_gives_the_naive_result(skewed):
    assert same_rows(d.anomalies(skewed), bench.naive_anomalies(skewed))


def test_row_order_does_not_matter(skewed):
    shuffled = skewed.orderBy(F.xxhash64("trade_id", "event_ms", "symbol"))
    assert same_rows(d.anomalies(skewed), d.anomalies(shuffled))


def test_bar_invariants(skewed):
    bars = b.bars(to_silver(skewed))
    wrong = bars.where(
        "buy_volume + sell_volume <> volume OR low > open_price OR low > close_price"
        " OR high < open_price OR high < close_price"
    )
    assert wrong.isEmpty()
    assert bars.agg(F.sum("trade_count")).first()[0] == skewed.count()


def test_every_trade_has_its_lag(skewed):
    silver = to_silver(skewed)
    ticks = trade_gaps(silver)
    order = Window.partitionBy("symbol").orderBy("event_time", "trade_id")
    plain = silver.withColumn("previous_time", F.lag("event_time").over(order))
    columns = ["symbol", "event_time", "trade_id", "price", "quantity", "previous_time"]
    assert same_rows(ticks.select(columns), plain.select(columns))
    # Only a symbol's first trade has no predecessor.
    assert ticks.where("previous_time IS NULL").count() == silver.select("symbol").distinct().count()
    naive = bench.naive_gaps(silver, Thresholds()).select("symbol", "trade_id", "gap_ms")
    assert same_rows(ticks.where("gap_ms >= 60000").select("symbol", "trade_id", "gap_ms"), naive)
