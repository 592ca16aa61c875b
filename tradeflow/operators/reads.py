"""Top-n reports over the published tables. Each task keeps n rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.schema import SILVER_PUBLISHED

REPORT = ["window_start", "symbol", "anomaly_type", "severity", "metric", "details"]
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM")


def latest_trades(silver: DataFrame, n: int = 100) -> DataFrame:
    """Newest trades; ties are ordered by the remaining columns."""
    ties = [c for c in SILVER_PUBLISHED if c != "event_time"]
    return silver.select(SILVER_PUBLISHED).orderBy(F.desc("event_time"), *ties).limit(n)


def recent_anomalies(
    anomalies: DataFrame, severities: Sequence[str] = SEVERITIES, n: int = 200
) -> DataFrame:
    """Newest findings of the given severities; ties by the remaining columns."""
    ties = [c for c in REPORT if c != "window_start"]
    return (
        anomalies.where(F.col("severity").isin(*severities))
        .select(REPORT)
        .orderBy(F.desc("window_start"), *ties)
        .limit(n)
    )
