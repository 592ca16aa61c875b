"""The shape of the plans: what is read, shuffled and evaluated how often."""

import contextlib
import io
import re

import pytest

from tradeflow.operators import bars as b
from tradeflow.operators.detect import anomalies, data_quality
from tradeflow.operators.silver import to_silver
from tradeflow.plans import written
from tradeflow.plans.queries import QUERIES
from tradeflow.sources.events import read_events, trades_from_events
from tradeflow.sources.trades import parse_trades, publish_trades

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


WRITTEN = [key for key in QUERIES if hasattr(written, key)]


@pytest.mark.parametrize(
    "key", [k for k in QUERIES if not k.startswith("stream_") and k not in WRITTEN]
)
def test_no_python_and_no_cross_join(spark, key):
    text = plan(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert not re.search(r"Python|Pandas", text)


def test_columns_and_filters_reach_the_scan(spark):
    text = plan(QUERIES["event_time"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    assert "PushedFilters: [IsNotNull(ts)]" in plan(QUERIES["ohlcv_5m"](spark, SF))


def test_text_is_parsed_once(spark):
    raw = trades_from_events(read_events(spark, SF))
    text = plan(to_silver(parse_trades(publish_trades(raw))))
    assert "from_json" not in "".join(re.findall(r"Condition : .*", text))
    conditions = "".join(re.findall(r"Condition : .*", plan(data_quality(raw))))
    assert "try_cast" not in conditions and "regexp_extract" not in conditions


def test_bars_shuffle_once(spark):
    raw = trades_from_events(read_events(spark, SF))
    assert len(re.findall(r"^\(\d+\) Exchange", plan(b.bars(to_silver(raw))), re.M)) == 1


@pytest.mark.parametrize("key", ["ohlcv_5m", "bar_features", "intertrade_gap", "anomalies"])
def test_trades_are_not_sorted_to_be_aggregated(spark, key):
    text = plan(QUERIES[key](spark, SF))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_gaps_shuffle_twice(spark):
    text = plan(QUERIES["intertrade_gap"](spark, SF))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2


def test_anomalies_read_trades_twice_and_shuffle_three_times(spark):
    text = plan(anomalies(trades_from_events(read_events(spark, SF))))
    assert len(re.findall(r"^\(\d+\) Scan", text, re.M)) == 2
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 3


def test_ranks_are_limited_before_the_shuffle(spark):
    text = plan(QUERIES["open_rank"](spark, SF))
    assert text.index("WindowGroupLimit") != text.rindex("WindowGroupLimit")
    assert "Partial" in text


def test_reports_keep_n_rows_per_task(spark):
    for key in ("latest_trades", "recent_anomalies"):
        assert "TakeOrderedAndProject" in plan(QUERIES[key](spark, SF))
