"""Keyed state for what looks back past a window: bars, their rolling mean, gaps.

One processor sits behind the five-second aggregate, so it sees one row per symbol and
window, not per trade. Nothing in it is ordered but the windows of one bar and, as bits,
the open bars.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import islice, takewhile
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Workers receive the processors whole, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What the state holds of a five-second window, times in microseconds.
WINDOW = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("window_start", T.LongType()), ("low", T.DoubleType()), ("high", T.DoubleType()),
            ("volume", T.DoubleType()), ("trade_count", T.LongType()),
            ("buy_volume", T.DoubleType()), ("sell_volume", T.DoubleType()),
            ("first_time", T.LongType()), ("first_id", T.LongType()),
            ("first_price", T.DoubleType()), ("first_quantity", T.DoubleType()),
            ("last_time", T.LongType()), ("last_price", T.DoubleType()),
        )
    ]
)

# What the state holds of a symbol beside its open bars.
PAST = T.StructType(
    [
        T.StructField("volumes", T.ArrayType(T.DoubleType())),
        T.StructField("last_time", T.LongType()),
        T.StructField("timer_ms", T.LongType()),
    ]
)

# What the processor returns: bars (no ``burst_start``), windows, and windows as gaps.
FEATURES = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("burst_start", T.LongType()),
        T.StructField("window_end", T.LongType()),
        *WINDOW.fields,
        T.StructField("avg_vol_20", T.DoubleType()),
        T.StructField("previous_time", T.LongType()),
    ]
)
TIMES = ("burst_start", "window_start", "window_end", "first_time", "last_time", "previous_time")


class BarSet:
    """A set of bar starts, one bit each in numbers of ``WIDE`` bars: a symbol's open bars can
    be millions after a long backlog, and no order of the state helps to walk through them."""

    WIDE = 1024

    def __init__(self, length: int, starts: Iterable[int] = ()):
        self.length = length
        self.masks: dict[int, int] = {}
        self.update(starts)

    def update(self, starts: Iterable[int]) -> None:
        for start in starts:
            block, bit = divmod(start // self.length, self.WIDE)
            self.masks[block] = self.masks.get(block, 0) | 1 << bit

    def discard(self, start: int) -> None:
        block, bit = divmod(start // self.length, self.WIDE)
        mask = self.masks.get(block, 0) & ~(1 << bit)
        if mask:
            self.masks[block] = mask
        else:
            self.masks.pop(block, None)

    def __contains__(self, start: int) -> bool:
        block, bit = divmod(start // self.length, self.WIDE)
        return bool(self.masks.get(block, 0) >> bit & 1)

    def __iter__(self) -> Iterator[int]:
        """The bar starts in order."""
        for block in sorted(self.masks):
            mask = self.masks[block]
            for bit in range(self.WIDE):
                if mask >> bit & 1:
                    yield (block * self.WIDE + bit) * self.length


class BarProcessor(StatefulProcessor):
    """Bars, and gaps inside them, out of the closed five-second windows of a symbol.

    A window goes on at once. When the watermark has passed the end of a bar, all its at
    most 60 windows have come, and they are folded; windows of a bar that is still open
    are kept in the state under the bar, and a timer at the end of the first open bar
    closes it if no further trade comes. A call holds ``held`` windows; those of a
    longer backlog wait in the state too. Beside open bars the state is the last
    volumes, the last time and the timer.
    """

    def __init__(
        self, windows: int, bar_sec: int, burst_sec: int, gap_ms: float, held: int = 50_000
    ):
        self.windows = windows
        self.bar = bar_sec * 1_000_000
        self.burst = burst_sec * 1_000_000
        self.gap_ms = gap_ms
        self.held = held

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        start = T.StructType([T.StructField("bar_start", T.LongType())])
        windows = T.StructType([T.StructField("windows", T.ArrayType(WINDOW))])
        self.open = handle.getMapState("open_bars", start, windows)
        self.past = handle.getValueState("past", PAST)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        stored = self._stored()
        bars: dict[int, list[tuple]] = {}
        count = 0
        for row in rows:
            window = tuple(row[name] for name in WINDOW.fieldNames())
            start = row["window_start"]
            bars.setdefault(start - start % self.bar, []).append(window)
            count += 1
            if count % self.held == 0:
                self._keep(bars, stored)
            yield Row(*FEATURES.fieldNames())(
                key[0], start, start + self.burst, *window, None, None
            )
        yield from self._close(key, bars, stored, timerValues)

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[Row]:
        stored = self._stored()
        yield from self._close(key, {}, stored, timerValues)

    def _stored(self) -> BarSet:
        return BarSet(self.bar, (bar for (bar,) in self.open.keys()))

    def _keep(self, bars: dict[int, list[tuple]], stored: BarSet) -> None:
        """Move windows from memory to the state."""
        for bar, windows in bars.items():
            if bar in stored:
                windows = [*map(tuple, self.open.getValue((bar,))[0]), *windows]
            self.open.updateValue((bar,), (windows,))
        stored.update(bars)
        bars.clear()

    def _close(
        self, key: Any, bars: dict[int, list[tuple]], stored: BarSet, timerValues: Any
    ) -> Iterator[Row]:
        """Fold, in order, the bars that the watermark has passed; keep the others."""
        closed = timerValues.getCurrentWatermarkInMs() * 1000 - self.bar
        recent, previous, timer = self.past.get() or ([], None, None)
        recent = list(recent)
        known = BarSet(self.bar, stored)
        known.update(bars)
        for bar in takewhile(lambda b: b <= closed, known):
            windows = bars.pop(bar, [])
            if bar in stored:
                windows += map(tuple, self.open.getValue((bar,))[0])
                self.open.removeKey((bar,))
                stored.discard(bar)
            windows.sort(key=lambda w: w[0])
            folded = [dict(zip(WINDOW.fieldNames(), w, strict=True)) for w in windows]
            yield from self._gaps(key, folded)
            whole = self._whole(bar, folded)
            recent = [*recent, whole["volume"]][-self.windows :]
            yield Row(*FEATURES.fieldNames())(
                key[0], None, bar + self.bar, *whole.values(), sum(recent) / len(recent), previous
            )
            previous = whole["last_time"]
        self._keep(bars, stored)
        opened = next(iter(stored), None)
        due = None if opened is None else (opened + self.bar) // 1000
        if due is not None and due != timer:
            self.handle.registerTimer(due)
        self.past.update((recent, previous, due))

    def _gaps(self, key: Any, windows: list[dict]) -> Iterator[Row]:
        """Windows of a bar whose first trade comes long after the window before."""
        for before, window in zip(windows, windows[1:], strict=False):
            seconds = window["first_time"] // 1_000_000 - before["last_time"] // 1_000_000
            if seconds * 1000 >= self.gap_ms:
                start = window["window_start"]
                as_gap = {**window, "trade_count": 0}  # the window itself has gone on already
                yield Row(*FEATURES.fieldNames())(
                    key[0], start, start + self.burst, *as_gap.values(), None, before["last_time"]
                )

    @staticmethod
    def _whole(bar: int, windows: list[dict]) -> dict:
        return {
            **windows[0],
            "window_start": bar,
            "low": min(w["low"] for w in windows),
            "high": max(w["high"] for w in windows),
            "last_time": windows[-1]["last_time"],
            "last_price": windows[-1]["last_price"],
            **{
                name: sum(w[name] for w in windows)
                for name in ("volume", "trade_count", "buy_volume", "sell_volume")
            },
        }

    def close(self) -> None:
        pass


class FramedBars(StatefulProcessor):
    """A ``BarProcessor`` that takes frames and returns frames of at most ``rows`` rows.

    A worker keeps whatever a processor of rows returns for one key until the key is
    done, so its memory would grow with the windows of a symbol; frames leave one by one.
    """

    def __init__(self, bars: BarProcessor, rows: int = 10_000):
        self.bars = bars
        self.rows = rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bars.init(handle)

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        windows = (row for frame in rows for row in _windows_of(frame))
        yield from self._frames(self.bars.handleInputRows(key, windows, timerValues))

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[pd.DataFrame]:
        yield from self._frames(self.bars.handleExpiredTimer(key, timerValues, expiredTimerInfo))

    def _frames(self, found: Iterable[Row]) -> Iterator[pd.DataFrame]:
        found = iter(found)
        while part := list(islice(found, self.rows)):
            # Objects, so that a missing whole number makes no fractions of its column.
            yield pd.DataFrame(part, columns=FEATURES.fieldNames(), dtype=object)

    def close(self) -> None:
        self.bars.close()


def _windows_of(frame: pd.DataFrame) -> Iterator[dict]:
    names = list(frame.columns)
    for values in frame.itertuples(index=False, name=None):
        row = dict(zip(names, values, strict=True))
        trade_id = row["first_id"]
        row["first_id"] = int(trade_id) if isinstance(trade_id, str) else None
        yield row


def with_bars_stream(windows: DataFrame, processor: BarProcessor) -> DataFrame:
    """Bars, windows and gaps out of a stream of closed five-second windows.

    Times cross to Python as microseconds, so no time zone of a worker can touch them;
    ``closed_at`` alone stays a time, because it carries the watermark of the timers. The
    trade id, which may be missing, crosses as text: a frame would make it a fraction.
    """
    plain = windows.select(
        "symbol",
        F.col("window_end").alias("closed_at"),
        *(
            F.unix_micros(f.name).alias(f.name) if f.name in TIMES else F.col(f.name)
            for f in WINDOW.fields
            if f.name != "first_id"
        ),
        F.col("first_id").cast("string").alias("first_id"),
    )
    result = plain.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=FramedBars(processor),
        outputStructType=FEATURES,
        outputMode="Append",
        timeMode="EventTime",
    )
    # A frame takes NaN, as a sum beyond all numbers can be, for missing. No number of a
    # window is missing, and the mean is missing on windows only.
    numbers = [f.name for f in WINDOW.fields if isinstance(f.dataType, T.DoubleType)]
    mean = "IF(burst_start IS NULL, coalesce(avg_vol_20, DOUBLE('NaN')), NULL)"
    return result.withColumns(
        {
            **{name: F.expr(f"coalesce({name}, DOUBLE('NaN'))") for name in numbers},
            "avg_vol_20": F.expr(mean),
            **{name: F.timestamp_micros(name) for name in TIMES},
        }
    )
