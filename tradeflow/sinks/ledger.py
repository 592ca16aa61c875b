"""Write a batch in pieces: each is tried again when it fails, and written once."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.session import exists

# Fixed value: how often a failed write is tried again.
RETRIES = 3


def retried(
    action: Callable[[], None], retries: int = RETRIES, first_wait: float = 1.0, sleep=time.sleep
) -> None:
    """Run ``action``; after a failure wait, twice as long each time, and run it again."""
    for attempt in range(retries + 1):
        try:
            return action()
        except Exception:
            if attempt == retries:
                raise
            sleep(first_wait * 2**attempt)


def write_once(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    ledger: str,
    *,
    rows_per_piece: int | None = None,
    retries: int = RETRIES,
    first_wait: float = 1.0,
    sleep=time.sleep,
) -> int:
    """Hand ``df`` to ``write`` in pieces, and note each written one in the folder ``ledger``.

    For targets that only append, as a database does. A batch that runs again, with the
    same ledger, writes the pieces that are not noted yet; so a repeated batch is not
    appended twice, and a failure in its middle repeats one piece at most: the one that
    was written and not noted. Rows fall into pieces by their content, so a repeated
    batch has the same pieces. Returns the number of pieces written now.
    """
    spark = df.sparkSession
    header, pieces = f"{ledger}/pieces", 1
    if exists(spark, f"{header}/_SUCCESS"):
        pieces = int(spark.read.text(header).first()[0])
    else:
        if rows_per_piece:
            pieces = max(1, -(-df.count() // rows_per_piece))
        noted = spark.createDataFrame([(str(pieces),)], "value string").coalesce(1)
        noted.write.mode("overwrite").text(header)
    piece = F.pmod(F.xxhash64(*df.columns), F.lit(pieces))
    written = 0
    for k in range(pieces):
        done = f"{ledger}/piece={k}"
        if exists(spark, f"{done}/_SUCCESS"):
            continue
        part = df if pieces == 1 else df.where(piece == k)
        retried(lambda part=part: write(part), retries, first_wait, sleep)
        spark.createDataFrame([], "value string").write.mode("overwrite").text(done)
        written += 1
    return written
