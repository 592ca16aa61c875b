"""Times the headline queries and prints one JSON line.

``naive_*`` are the same results written the straightforward way: one aggregate
or rank per branch, a per-trade LAG for the gaps. They show what the plan shapes
used by the library are worth and are not part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradeflow.config import Thresholds  # noqa: E402
from tradeflow.operators import bars as b  # noqa: E402
from tradeflow.operators import detect as d  # noqa: E402
from tradeflow.operators.silver import to_silver  # noqa: E402
from tradeflow.plans.queries import QUERIES  # noqa: E402
from tradeflow.sources.events import read_events, trades_from_events  # noqa: E402

HEADLINE = [
    "parse_trades", "unwrap_envelope", "silver_lake", "warehouse_layout", "partition_manifest",
    "ohlcv_5m", "burst_5s", "bar_features", "intertrade_lag", "volume_spike", "intertrade_gap",
    "data_quality", "anomalies", "recent_anomalies",
]
STREAMS = ["stream_anomalies"]


def naive_gaps(silver: DataFrame, t: Thresholds) -> DataFrame:
    """LAG over every trade of a symbol, in one task per symbol."""
    order = Window.partitionBy("symbol").orderBy("event_time", "trade_id")
    lagged = silver.withColumn("previous_time", F.lag("event_time").over(order))
    first = {"time": "event_time", "id": "trade_id", "price": "price", "quantity": "quantity"}
    return d.emit(lagged, [d.intertrade_gap(t, first, "previous_time")])


def naive_anomalies(trades: DataFrame) -> DataFrame:
    """Seven branches, each from the raw trades; bars by ranks and joins."""
    t = Thresholds()
    silver = to_silver(trades)
    parts = [d.emit(b.bar_features(b.bars_by_join(silver)), [f]) for f in d.bar_findings(t)]
    parts.append(d.emit(b.bursts(silver), [d.burst_of_trades(t)]))
    parts.append(naive_gaps(silver, t))
    result = d.data_quality(trades)
    for part in parts:
        result = result.unionByName(part)
    return result


def seconds(run, repeats: int) -> float:
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tradeflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    wanted = sys.argv[1:] or [*HEADLINE, *STREAMS]

    trades = read_events(spark, sf_dir).count()
    times = {
        key: seconds(lambda key=key: QUERIES[key](spark, sf_dir), 1 if key in STREAMS else 3)
        for key in wanted
    }
    naive = {}
    if not sys.argv[1:]:
        raw = trades_from_events(read_events(spark, sf_dir))
        naive = {
            "naive_ohlcv_5m": seconds(lambda: b.bars_by_join(to_silver(raw)), 3),
            "naive_intertrade_gap": seconds(lambda: naive_gaps(to_silver(raw), Thresholds()), 3),
            "naive_anomalies": seconds(lambda: naive_anomalies(raw), 3),
        }
    result = {
        "metric": "headline queries, total of the best run of each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "trades": trades,
        "naive": naive,
    }
    if "anomalies" in times:
        result["anomalies_trades_per_sec"] = round(trades / times["anomalies"])
    if "stream_anomalies" in times:
        result["stream_trades_per_sec"] = round(trades / times["stream_anomalies"])
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
