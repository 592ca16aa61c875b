"""Typed trades, and the rows and column sets the sinks keep of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.functions.columns import ISO_MILLIS, computed_once, with_partitions
from tradeflow.schema import PARTITIONS, SILVER, SILVER_PUBLISHED, WIRE_FIELDS


def typed(trades: DataFrame) -> DataFrame:
    """Raw trades with ``price`` and ``quantity`` as numbers, NULL if unparsable.

    NaN and infinities count as unparsable: Spark orders NaN above every number,
    so one such price would satisfy every "at least" threshold.
    """
    parsed = computed_once(
        trades, price="try_cast(price AS double)", quantity="try_cast(qty AS double)"
    )
    finite = "IF(abs({0}) < double('Infinity'), {0}, NULL) AS {0}"
    return parsed.selectExpr(
        "* EXCEPT (price, quantity)", finite.format("price"), finite.format("quantity")
    )


def to_silver(trades: DataFrame) -> DataFrame:
    """Raw trades to typed trades.

    Rows without a symbol, or whose price or quantity is missing or not a finite
    number, are left out; the data quality detector reports them. Zero and
    negative values stay.
    """
    return (
        typed(trades)
        .where("symbol IS NOT NULL AND price IS NOT NULL AND quantity IS NOT NULL")
        .selectExpr("*", "timestamp_millis(trade_ms) AS trade_time", "trade_ms AS trade_time_ms")
        .select(SILVER.fieldNames())
    )


def bronze(trades: DataFrame) -> DataFrame:
    """Every raw record as a JSON line under its wire names, with ``ts``.

    The wire names differ only by case, so they live inside the text: a table
    could not hold them side by side. ``parse_trades`` reads the text back.
    """
    record = F.struct(
        *(F.col(name).alias(wire) for wire, name, _ in WIRE_FIELDS),
        F.date_format("event_time", ISO_MILLIS).alias("ts"),
    )
    line = F.to_json(record, {"ignoreNullFields": "false"})
    return with_partitions(trades, "event_time").select(line.alias("value"), *PARTITIONS)


def bronze_text(judged: DataFrame) -> DataFrame:
    """Good messages as they came, in one line each, with ``ts`` as a last field.

    Unlike ``bronze`` this keeps fields that the library does not know. Line breaks in
    JSON stand between its tokens only, so a blank does as well.
    """
    line = F.translate("message", "\n\r", "  ")
    head = F.rtrim(F.regexp_replace(line, r"\}[ \t]*$", ""))
    time = F.concat(F.lit('"'), F.date_format("event_time", ISO_MILLIS), F.lit('"'))
    value = F.when(
        line.rlike(r"^[ \t]*\{.*\}[ \t]*$"),
        F.concat(
            head,
            F.when(head.endswith("{"), "").otherwise(","),
            F.lit('"ts":'),
            F.coalesce(time, F.lit("null")),
            F.lit("}"),
        ),
    ).otherwise(line)
    lines = with_partitions(judged.where("reason IS NULL"), "event_time")
    return lines.select(value.alias("value"), *PARTITIONS)


def silver_lake(silver: DataFrame) -> DataFrame:
    return with_partitions(silver.select(SILVER_PUBLISHED), "event_time")


def anomalies_lake(anomalies: DataFrame) -> DataFrame:
    return with_partitions(anomalies, "window_start")
