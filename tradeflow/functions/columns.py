"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"

def computed_once(df: DataFrame, **expensive: str) -> DataFrame:
    """Add columns, given as SQL, that later filters read instead of repeating.

    Catalyst moves a filter below a projection and repeats the projected
    expression in it, once per mention: a filter on three parsed fields parses
    the text four times. It does not move a filter below a generator, and a
    generator over one struct yields exactly one row. Columns of the same name
    are replaced; columns not named here are still pruned.
    """
    values = ", ".join(f"'{name}', {sql}" for name, sql in expensive.items())
    kept = [f"`{c}`" for c in df.columns if c not in expensive]
    return df.selectExpr(*kept, f"inline(array(named_struct({values})))")


def with_partitions(df: DataFrame, time_column: str) -> DataFrame:
    """Add the day and hour strings that partition the lake."""
    return df.withColumns(
        {
            "dt": F.date_format(time_column, "yyyy-MM-dd"),
            "hour_bucket": F.date_format(time_column, "HH"),
        }
    )


def stream_name(symbol: str = "symbol") -> Column:
    return F.concat(F.lower(symbol), F.lit("@trade"))
