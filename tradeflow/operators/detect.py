"""The seven detectors.

A detector is a condition and a record over the columns of its input, both as SQL
expressions. Detectors of one input are emitted together, so the input is computed
once however many detectors read it (in a stream: one state store, not one per
detector).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tradeflow.config import Rule, Thresholds
from tradeflow.operators.bars import BAR_SEC, BURST_SEC, summarise, window_features
from tradeflow.operators.silver import to_silver, typed
from tradeflow.schema import ANOMALY


@dataclass(frozen=True)
class Finding:
    hit: str
    record: str


def _severity(metric: str, rule: Rule, *, falling: bool = False) -> str:
    """CRITICAL, HIGH or MEDIUM by the rule's bounds, outermost first."""
    reached = "<=" if falling else ">="
    grades = [
        f"WHEN {metric} {reached} DOUBLE({bound}) THEN '{grade}'"
        for bound, grade in ((rule.critical, "CRITICAL"), (rule.high, "HIGH"))
        if bound is not None
    ]
    return f"CASE {' '.join(grades)} ELSE 'MEDIUM' END" if grades else "'MEDIUM'"


def _record(**values: str | float) -> str:
    """All columns of the anomaly table, in order and type; absent ones are zero."""
    fields = (
        f"'{f.name}', CAST({values.get(f.name, 0)} AS {f.dataType.simpleString()})"
        for f in ANOMALY.fields
    )
    return f"named_struct({', '.join(fields)})"


def emit(df: DataFrame, findings: list[Finding]) -> DataFrame:
    """One row per finding that holds.

    Rows without any finding are dropped before the records are built.
    """
    hits = df.where(" OR ".join(f"({f.hit})" for f in findings))
    if len(findings) == 1:
        return hits.selectExpr(f"{findings[0].record} AS r").select("r.*")
    records = ", ".join(f"IF({f.hit}, {f.record}, NULL)" for f in findings)
    return hits.selectExpr(f"inline(array_compact(array({records})))")


def _bar_record(name: str, category: str, direction: str, **values: str | float) -> str:
    return _record(
        window_start="window_start",
        window_end="window_end",
        symbol="symbol",
        anomaly_type=f"'{name}'",
        category=f"'{category}'",
        direction=f"'{direction}'",
        window_sec=BAR_SEC,
        trade_time="window_end",
        price="close_price",
        volume="volume",
        trade_count="trade_count",
        buy_volume="buy_volume",
        sell_volume="sell_volume",
        **values,
    )


def price_spike_up(t: Thresholds) -> Finding:
    rule = t.price_spike_up
    return Finding(
        f"pct_change >= DOUBLE({rule.trigger})",
        _bar_record(
            "price_spike_up_5m", "price", "UP",
            severity=_severity("pct_change", rule),
            metric="pct_change",
            threshold=rule.reported,
            details="concat('Δ%=', round(pct_change, 3))",
        ),
    )


def price_spike_down(t: Thresholds) -> Finding:
    rule = t.price_spike_down
    return Finding(
        f"pct_change <= DOUBLE({rule.trigger})",
        _bar_record(
            "price_spike_down_5m", "price", "DOWN",
            severity=_severity("pct_change", rule, falling=True),
            metric="pct_change",
            threshold=rule.reported,
            details="concat('Δ%=', round(pct_change, 3))",
        ),
    )


def volatility_spike(t: Thresholds) -> Finding:
    rule = t.volatility_spike
    return Finding(
        f"range_pct >= DOUBLE({rule.trigger})",
        _bar_record(
            "volatility_spike_5m", "price", "FLAT",
            severity=_severity("range_pct", rule),
            metric="range_pct",
            threshold=rule.reported,
            details="concat('Range%=', round(range_pct, 3))",
        ),
    )


def volume_spike(t: Thresholds) -> Finding:
    rule, ratio = t.volume_spike, "try_divide(volume, avg_vol_20)"
    return Finding(
        f"avg_vol_20 > 0 AND {ratio} >= DOUBLE({rule.trigger})",
        _bar_record(
            "volume_spike_5m", "volume", "FLAT",
            severity=_severity(ratio, rule),
            metric=ratio,
            threshold=rule.reported,
            details=f"concat('Volume x=', round({ratio}, 2))",
        ),
    )


def bar_findings(t: Thresholds) -> list[Finding]:
    """Over bars with ``pct_change``, ``range_pct`` and ``avg_vol_20``."""
    return [price_spike_up(t), price_spike_down(t), volatility_spike(t), volume_spike(t)]


def intertrade_gap(t: Thresholds, first: dict[str, str], previous: str) -> Finding:
    """A long silence before the row's first trade.

    A gap this long can only end on the first trade of a window that is no
    longer than the gap, so windows are enough to find every one. Both times are
    cut to whole seconds first.
    """
    rule, time = t.intertrade_gap, first["time"]
    if rule.trigger < BURST_SEC * 1000:
        raise ValueError(f"gap trigger must be at least {BURST_SEC} s, the window length")
    gap = f"(unix_seconds({time}) - unix_seconds({previous})) * 1000"
    return Finding(
        f"{gap} >= DOUBLE({rule.trigger})",
        _record(
            window_start=time,
            window_end=time,
            symbol="symbol",
            anomaly_type="'intertrade_gap'",
            category="'time'",
            severity=_severity(gap, rule),
            direction="'FLAT'",
            metric=gap,
            threshold=rule.reported,
            trade_id=first["id"],
            trade_time=time,
            price=first["price"],
            quantity=first["quantity"],
            gap_ms=gap,
            details=f"concat('Gap ms=', {gap})",
        ),
    )


def gap_slice_sec(t: Thresholds) -> int:
    """The longest slice of a minute, in whole seconds, in which no gap can lie."""
    reach = int(t.intertrade_gap.trigger // 1000)
    return max((s for s in range(1, 61) if 60 % s == 0 and s <= reach), default=1)


def burst_of_trades(t: Thresholds) -> Finding:
    """Over five-second windows."""
    rule = t.burst_of_trades
    return Finding(
        f"trade_count >= DOUBLE({rule.trigger})",
        _record(
            window_start="window_start",
            window_end="window_end",
            symbol="symbol",
            anomaly_type="'burst_of_trades'",
            category="'time'",
            severity=_severity("trade_count", rule),
            direction="'FLAT'",
            metric="trade_count",
            threshold=rule.reported,
            window_sec=BURST_SEC,
            trade_time="window_end",
            volume="volume",
            trade_count="trade_count",
            details="concat('Trades/5s=', trade_count)",
        ),
    )


def data_quality(trades: DataFrame) -> DataFrame:
    """Raw trades with a missing, unparsable, zero or negative field."""
    invalid = (
        "symbol IS NULL OR price IS NULL OR quantity IS NULL OR price <= 0 OR quantity <= 0"
    )
    record = _record(
        window_start="event_time",
        window_end="event_time",
        symbol="symbol",
        anomaly_type="'data_quality'",
        category="'data'",
        severity="'HIGH'",
        direction="'FLAT'",
        metric=1.0,
        threshold=1.0,
        trade_id="trade_id",
        trade_time="event_time",
        price="price",
        quantity="quantity",
        details="'Invalid/null fields detected'",
    )
    return emit(typed(trades), [Finding(invalid, record)])


FIRST_TRADE = {
    "time": "first_time",
    "id": "first_id",
    "price": "first_price",
    "quantity": "first_quantity",
}


def window_anomalies(features: DataFrame, t: Thresholds) -> DataFrame:
    """All findings over ``window_features``: bars, bursts and gaps."""
    burst = burst_of_trades(t)
    return emit(
        features,
        [Finding(f"burst_start IS NULL AND {f.hit}", f.record) for f in bar_findings(t)]
        + [Finding(f"burst_start IS NOT NULL AND {burst.hit}", burst.record)]
        + [intertrade_gap(t, FIRST_TRADE, "previous_time")],
    )


def gap_anomalies(silver: DataFrame, t: Thresholds | None = None) -> DataFrame:
    """Gaps alone, in two shuffles: trades are combined into slices of a symbol, the
    longest that hold no gap inside, and a slice looks back at the one before it.

    The lag orders slices, not trades: a symbol has one a minute in which it traded,
    so a hot symbol is no hot task.
    """
    t = t or Thresholds()
    slices = summarise(silver, f"{gap_slice_sec(t)} seconds")
    lagged = slices.selectExpr(
        "symbol",
        *FIRST_TRADE.values(),
        "lag(last_time) OVER (PARTITION BY symbol ORDER BY window_start) AS previous_time",
    )
    return emit(lagged, [intertrade_gap(t, FIRST_TRADE, "previous_time")])


def anomalies(trades: DataFrame, t: Thresholds | None = None) -> DataFrame:
    """All seven detectors over a batch of raw trades.

    The trades are read twice: once for every windowed detector, once for the
    row-by-row quality check, which needs no shuffle.
    """
    t = t or Thresholds()
    features = window_features(to_silver(trades), t.volume_windows)
    return window_anomalies(features, t).unionByName(data_quality(trades))
