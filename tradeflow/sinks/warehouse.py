"""The warehouse: tables by day, sorted within the day, or a JDBC database."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.config import JdbcTarget
from tradeflow.sinks.ledger import RETRIES, write_once
from tradeflow.sinks.spread import spread


@dataclass(frozen=True)
class Layout:
    """Which column dates a row, and the sort order inside a day."""

    time: str
    order: tuple[str, ...]


# Layout of the warehouse tables.
LAYOUTS = {
    "bronze": Layout("event_time", ("symbol", "trade_ms")),
    "silver": Layout("event_time", ("symbol", "trade_time")),
    "anomalies": Layout("window_start", ("symbol", "window_start", "anomaly_type")),
}

PIECE_ROWS = 1_000_000
EPOCH = "1970-01-01 00:00:00"


def to_warehouse_types(df: DataFrame) -> DataFrame:
    """Flags as 0/1, and the type's default for missing values.

    The warehouse columns cannot be null: text becomes empty, numbers zero, times
    the epoch.
    """
    columns = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            column, default = column.cast("tinyint"), F.lit(0).cast("tinyint")
        elif isinstance(f.dataType, T.StringType):
            default = F.lit("")
        elif isinstance(f.dataType, T.TimestampType):
            default = F.lit(EPOCH).cast("timestamp")
        else:
            default = F.lit(0).cast(f.dataType)
        columns.append(F.coalesce(column, default).alias(f.name))
    return df.select(columns)


def arranged(df: DataFrame, layout: Layout, rows_per_task: int | None = None) -> DataFrame:
    """Add the day and sort each task's rows by (day, layout order).

    Rows are brought together by day and symbol, so a file holds few symbols in
    order and its statistics let readers skip; a large symbol of a day is split
    over several files. One pass: a range shuffle would read its input twice.
    """
    dated = df.withColumn("event_date", F.to_date(layout.time))
    placed = spread(dated, ["event_date", layout.order[0]], rows_per_task)
    return placed.sortWithinPartitions("event_date", *layout.order)


def jdbc_options(target: JdbcTarget, table: str, batch_rows: int) -> dict[str, str]:
    options = {
        "url": target.url,
        "dbtable": table,
        "user": target.user,
        "password": target.password,
        "batchsize": str(batch_rows),
    }
    if target.driver:
        options["driver"] = target.driver
    return options


def jdbc_table(target: JdbcTarget, product: str) -> str:
    return {
        "bronze": target.bronze_table,
        "silver": target.silver_table,
        "anomalies": target.anomaly_table,
    }[product]


def write_warehouse(
    df: DataFrame,
    product: str,
    path: str | None = None,
    *,
    jdbc: JdbcTarget | None = None,
    batch_rows: int = 10_000,
    batch_id: int | None = None,
    run: str | None = None,
    rows_per_task: int | None = None,
    retries: int = RETRIES,
    ledger: str | None = None,
    mode: str = "append",
) -> None:
    """Append a product to its warehouse table.

    A table in a folder gets one sub-folder per day (and per ``run`` and batch,
    which a repeated batch of that run replaces). For a JDBC table ``ledger`` is a folder
    that notes what was appended of each batch, so a repeated one is not appended twice.
    """
    layout = LAYOUTS[product]
    typed = to_warehouse_types(df)
    if product == "silver":
        typed = typed.withColumn("ingest_time", F.current_timestamp())
    if jdbc is not None:
        options = jdbc_options(jdbc, jdbc_table(jdbc, product), batch_rows)
        # The time of arrival is set once a piece, behind its choice by content.
        plain = typed.drop("ingest_time")

        def append(part: DataFrame) -> None:
            if product == "silver":
                part = part.withColumn("ingest_time", F.current_timestamp())
            part.write.format("jdbc").options(**options).mode("append").save()

        if ledger is None or batch_id is None:
            append(plain)
        else:
            noted = f"{ledger}/{product}/{run or 'run'}/{batch_id}"
            write_once(plain, append, noted, rows_per_piece=PIECE_ROWS, retries=retries)
        return
    out, keys = arranged(typed, layout, rows_per_task), ["event_date"]
    if batch_id is not None:
        out, mode = out.withColumn("batch_id", F.lit(batch_id)), "overwrite"
        keys.append("batch_id")
        if run is not None:
            out = out.withColumn("run_id", F.lit(run))
            keys.insert(-1, "run_id")
    (
        out.write.mode(mode)
        .partitionBy(*keys)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(f"{path}/{product}")
    )
