"""Product codes of vectors, exact to the last integer, by memoised grid cells."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import checkpointed, fresh, ship, tidy
from tradeflow.llm.merges import TwoAges

SCALE = 1024
SETTLED = 1 << 22  # squares of integers up to this add up exactly in 64 bits
CELLS = 20_000  # remembered cells of each age and part
CHUNK = 1024
DIGIT = 30
LONGEST = 2**63 - 1


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of finite doubles, as 64-bit integers, or as Python's where too large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    if not scaled.size or np.abs(scaled).max() < SETTLED:
        return scaled.astype(np.int64)
    return np.array([math.floor(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE for x in values.tolist()],
                    dtype=object)


class Grid:
    """The nearest entries of one part's codebook, ties to the lower index.

    A part lies in a cell of a grid, a box of side 2^shift. Over the box every entry
    has a least and a greatest distance; one whose least distance is beyond the
    smallest greatest distance of all is nowhere in the box the nearest. The others
    are remembered for the cell, and only they are evaluated, in integers. Bounds are
    sums of tables by axis, in single precision with room for its rounding.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.exact = entries.dtype == object
        self.cells = TwoAges(CELLS)
        if self.exact or not entries.size:
            return
        distance = ((entries[:, None] - entries[None]) ** 2).sum(2)
        apart = np.where(distance > 0, distance, np.iinfo(np.int64).max).min(1)
        apart = apart[apart < np.iinfo(np.int64).max]
        # Boxes whose diagonal is about half the distance of neighbouring entries.
        side = math.sqrt(np.median(apart) / entries.shape[1]) / 2 if len(apart) else 1.0
        self.shift = max(0, int(math.log2(max(side, 1.0))))

    def _candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell, the entries that are the nearest of some point in it."""
        side = 1 << self.shift
        tables = []
        for axis in range(cells.shape[1]):
            values, back = np.unique(cells[:, axis], return_inverse=True)
            low = (values << self.shift)[:, None]
            entry = self.entries[:, axis]
            near = np.maximum(np.maximum(low - entry, entry - (low + side - 1)), 0)
            far = np.maximum(np.abs(entry - low), np.abs(low + side - 1 - entry))
            squares = [(d.astype(np.float64) ** 2).astype(np.float32) for d in (near, far)]
            tables.append((*squares, back))
        found = []
        for start in range(0, len(cells), CHUNK):
            rows = slice(start, start + CHUNK)
            least = np.zeros((len(cells[rows]), len(self.entries)), np.float32)
            most = np.zeros_like(least)
            for near, far, back in tables:
                least += near[back[rows]]
                most += far[back[rows]]
            room = np.float32(1 + 1e-4)
            kept = least <= (most.min(1) * room * room)[:, None]
            found += np.split(np.nonzero(kept)[1], np.cumsum(kept.sum(1))[:-1])
        return found

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of each point."""
        if self.exact or points.dtype == object:
            return self._nearest_exact(points)
        cells = np.ascontiguousarray(points >> self.shift)
        keys = cells.view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
        unique, at, back = np.unique(keys, return_index=True, return_inverse=True)
        names = [k.tobytes() for k in unique]
        lists = [self.cells.find(k) for k in names]
        new = [i for i, known in enumerate(lists) if known is None]
        if new:
            for i, found in zip(new, self._candidates(cells[at[new]]), strict=True):
                lists[i] = found.astype(np.uint16)
                self.cells.put(names[i], lists[i])
        index = np.empty(len(points), np.int64)
        squared = np.empty(len(points), np.int64)
        sizes = np.array([len(x) for x in lists])
        for rows in _portions(sizes[back], 1 << 16):
            parts = [lists[i] for i in back[rows]]
            counts = sizes[back[rows]]
            entry = np.concatenate(parts).astype(np.int64)
            starts = np.cumsum(counts) - counts
            d = np.repeat(points[rows], counts, axis=0) - self.entries[entry]
            d = np.einsum("ij,ij->i", d, d)
            best = np.minimum.reduceat(d, starts)
            hit = np.where(d == np.repeat(best, counts), entry, len(self.entries))
            index[rows] = np.minimum.reduceat(hit, starts)
            squared[rows] = best
        return index, squared

    def _nearest_exact(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same in integers of any size, for values that 64 bits may not hold."""
        entries = self.entries.astype(object)
        index, squared = np.empty(len(points), np.int64), np.empty(len(points), object)
        for i, point in enumerate(points.astype(object)):
            d = [sum((a - b) ** 2 for a, b in zip(point, e, strict=True)) for e in entries]
            squared[i] = min(d)
            index[i] = d.index(squared[i])
        return index, squared


def _portions(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of neighbouring items whose sizes add up to about ``most``."""
    total = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
        yield slice(start, stop)
        start = stop


def _padded(vectors: pa.Array, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, integers) of the vectors, zeros behind the short; apart those of large values."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    grid = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    grid[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    large = np.abs(grid).max(1, initial=0) >= SETTLED // SCALE
    found = []
    for kind in (~large, large):
        if kind.any():
            numbers = whole_numbers(grid[kind].ravel()).reshape(-1, width)
            found.append((np.flatnonzero(kind), numbers))
    return found


class Codebooks:
    """The entries of every part, and the codes that they give."""

    def __init__(self, entries: list[np.ndarray], width: int):
        self.width = width
        self.grids = [Grid(e) for e in entries]

    def assign(self, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(points, index, squared distance) of each part of the vectors."""
        for part, grid in enumerate(self.grids):
            points = numbers[:, part * self.width : (part + 1) * self.width]
            yield (points, *grid.nearest(points))


def _digits(sums: list[int]) -> list[list[int]]:
    """Numbers in base 2^30, least digits first; the last keep the sign."""
    count = max(2, *(abs(x).bit_length() // DIGIT + 1 for x in sums))
    mask = (1 << DIGIT) - 1
    lower = [[x >> DIGIT * k & mask for x in sums] for k in range(count - 1)]
    return [*lower, [x >> DIGIT * (count - 1) for x in sums]]


def _part_sums(batches, vector: str, entries: list[np.ndarray], width: int):
    """Sums and counts of the points of every entry, of one task."""
    books = Codebooks(entries, width)
    sums = [np.zeros(e.shape, np.int64) for e in entries]
    large = [np.zeros(e.shape, object) for e in entries]
    counts = [np.zeros(len(e), np.int64) for e in entries]
    for batch in batches:
        for _, numbers in _padded(batch.column(vector), width * len(entries)):
            for part, (points, index, _) in enumerate(books.assign(numbers)):
                size = len(entries[part])
                counts[part] += np.bincount(index, minlength=size)
                for axis in range(width):
                    if points.dtype == object:
                        np.add.at(large[part], (index, axis), points[:, axis])
                    else:  # exact: a batch adds up far below 2^53
                        added = np.bincount(index, points[:, axis], size)
                        sums[part][:, axis] += added.astype(np.int64)
    rows = []
    for part, seen in enumerate(counts):
        for entry in np.flatnonzero(seen).tolist():
            total = [int(a) + b for a, b in zip(sums[part][entry], large[part][entry], strict=True)]
            for place, digits in enumerate(_digits(total)):
                rows.append((part, entry, place, int(seen[entry]) if not place else 0, digits))
    if rows:
        names = ["part", "entry", "place", "n", "digits"]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names)


def _settled(entries: list[list[int]], width: int) -> np.ndarray:
    """Entries as 64-bit integers where these hold all distances, else as Python's."""
    small = all(abs(x) < SETTLED for e in entries for x in e)
    return np.array(entries, np.int64 if small else object).reshape(len(entries), width)


def _improved(vectors: DataFrame, vector: str, entries: list[np.ndarray], width: int):
    """One round: every entry moves to the floored mean of the points it is nearest to.

    Tasks add up their own points; at most ``parts`` times ``entries`` rows of each
    meet in an aggregate, and the driver gets the totals, as large as the codebooks.
    """
    kind = "part int, entry int, place int, n long, digits array<long>"
    sums = vectors.select(vector).mapInArrow(
        tidy(lambda batches: _part_sums(batches, vector, entries, width)), kind
    )
    totals = sums.groupBy("part", "entry", "place").agg(
        F.sum("n").alias("n"),
        F.array(*(F.sum(F.col("digits")[i]) for i in range(width))).alias("digits"),
    )
    books = [[list(map(int, e)) for e in part] for part in entries]
    found: dict[tuple[int, int], list] = {}
    for row in totals.collect():
        count_and_sums = found.setdefault((row["part"], row["entry"]), [0, [0] * width])
        count_and_sums[0] += row["n"]
        for i, digit in enumerate(row["digits"]):
            count_and_sums[1][i] += digit << DIGIT * row["place"]
    for (part, entry), (n, total) in found.items():
        books[part][entry] = [x // n for x in total]
    return [_settled(part, width) for part in books]


def _usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def fit_codebooks(
    vectors: DataFrame, id_column: str, vector: str, parts: int, entries: int, rounds: int
) -> tuple[list[np.ndarray], int]:
    """(entries of every part, width of a part), after so many rounds over all vectors."""
    longest = vectors.agg(F.max(F.size(vector))).first()[0] or 0
    width = max(1, -(-longest // parts))
    first = vectors.orderBy(F.col(id_column).asc_nulls_last(), vector).limit(entries)
    rows = [r[0] for r in first.select(vector).collect()]
    start = np.zeros((len(rows), width * parts))
    for i, row in enumerate(rows):
        start[i, : len(row)] = row
    numbers = whole_numbers(start.ravel()).reshape(start.shape)
    books = [
        _settled(numbers[:, p * width : (p + 1) * width].tolist(), width) for p in range(parts)
    ]
    if not rows:
        return books, width
    for _ in range(rounds):
        books = _improved(vectors, vector, books, width)
    return books, width


def codebooks_digest(books: list[np.ndarray]) -> str:
    """sha256 of all entries' components, by part, entry and place, joined by commas."""
    return hashlib.sha256(
        ",".join(str(x) for part in books for e in part for x in e).encode()
    ).hexdigest()


def compress_vectors(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
) -> DataFrame:
    """The rows of ``df`` whose vector is usable, with ``code``, ``error`` and ``codebooks_sha256``.

    Rows without a vector, or with a null or non-finite component, are left out. Every
    component becomes floor(1024 x); a vector is cut into equal consecutive parts, and
    each part is coded by the nearest entry of its codebook, two hex digits (so at most
    256 entries). Codebooks start as the parts of the smallest ids, in order of id, then
    of the vector, null ids last; each round moves an entry to the floored mean of its
    parts, and an entry without parts stays. ``error`` is the squared distance to the
    entries, summed over the parts; null where a long does not hold it.

    Vectors shorter than the longest, or of a length that ``parts`` does not divide,
    count as if zeros stood behind them. Repeated rows are coded each. With an empty
    table the result is empty. A result takes a leading underscore where ``df`` has a
    column of its name. Codebooks (``parts`` x ``entries`` rows of integers) are all
    that passes through the driver.
    """
    if not 1 <= entries <= 256 or parts < 1 or rounds < 0:
        raise ValueError("entries must be 1 to 256, parts 1 or more, rounds 0 or more")
    ship(df.sparkSession)
    numbers, coded, code, error, digest = fresh(
        df, "numbers", "coded", "code", "error", "codebooks_sha256"
    )
    kept = df.withColumn(numbers, F.col(vector).cast("array<double>")).filter(
        _usable(F.col(numbers))
    )
    books, width = fit_codebooks(kept, id_column, numbers, parts, entries, rounds)

    @F.arrow_udf("struct<code string, error long>")
    @tidy
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = Codebooks(books, width)
        for batch in batches:
            codes = np.zeros((len(batch), parts), np.uint8)
            errors = np.zeros(len(batch), object)
            for rows, found in _padded(batch, width * parts):
                for part, (_, index, squared) in enumerate(held.assign(found)):
                    codes[rows, part] = index
                    errors[rows] += squared.astype(object)
            yield pa.StructArray.from_arrays(
                [
                    pa.array([c.tobytes().hex() for c in codes], pa.string()),
                    pa.array([int(e) if e <= LONGEST else None for e in errors], pa.int64()),
                ],
                ["code", "error"],
            )

    return kept.select(*df.columns, encode(F.col(numbers)).alias(coded)).select(
        *df.columns,
        F.col(coded)["code"].alias(code),
        F.col(coded)["error"].alias(error),
        F.lit(codebooks_digest(books)).alias(digest),
    )


def with_group_sum(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of its ``key``; null keys are one group.

    The sums come from an aggregate that combines before its shuffle, and both sides
    of the join from checkpoints, so Spark can split the rows of a hot key. A sum that
    a long does not hold, and one of nulls only, is null.
    """
    other, total = fresh(df, "key", "total")
    df = checkpointed(df)
    sums = df.groupBy(F.col(key).alias(other)).agg(
        F.sum(F.col(value).cast("decimal(38,0)")).alias(total)
    )
    sums = checkpointed(sums.select(other, F.expr(f"try_cast(`{total}` AS long)").alias(total)))
    joined = df.join(sums, F.col(key).eqNullSafe(F.col(other)), "left")
    return joined.select(*df.columns, F.col(total).alias(name))
