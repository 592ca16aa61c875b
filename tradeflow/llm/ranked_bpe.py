"""Byte-level BPE by a file of ranks: recursive SQL over token positions, in every partition."""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import ship, tidy
from tradeflow.llm.merges import Remembered, has_unknown, loaded, plain_pieces

MEMORY = "400MB"
REMEMBERED = 400_000
LONG = 48  # bytes; longer pieces are contracted at many places a step
ROWS = 200_000  # token rows of one recursive query
STEPS_OF_ROWS = 4_000_000  # rows that the steps of a query may hold together
# A run of white space of which a space is a part: only there does a piece depend on
# more than the text between two spaces.
MIXED_SPACE = re.compile(r" \s|\s ")

# Each step contracts the leftmost pair of least rank of every word that has a pair.
# A row knows its right neighbour (u at q) and the rank of the pair of both, so a step
# looks up only the pairs that it changes.
LEFTMOST = """
WITH RECURSIVE step(n, w, p, t, q, u, best) AS (
    SELECT 0, f.w, f.p, f.t, f.q, f.u, m.r::BIGINT << 32 | f.p
    FROM (
        SELECT *, lead(p) OVER k AS q, lead(t) OVER k AS u
        FROM letters WINDOW k AS (PARTITION BY w ORDER BY p)
    ) f LEFT JOIN merges m ON m.a = f.t AND m.b = f.u
    UNION ALL
    SELECT n, w, p, t, q, u, CASE WHEN changed THEN m.r::BIGINT << 32 | p ELSE best END
    FROM (
        SELECT s.n + 1 AS n, s.w, s.p, s.best,
            CASE WHEN s.p = h.p THEN h.r ELSE s.t END AS t,
            CASE WHEN s.p = h.p THEN h.q ELSE s.q END AS q,
            CASE WHEN s.p = h.p THEN h.u WHEN s.q = h.p THEN h.r ELSE s.u END AS u,
            s.p = h.p OR coalesce(s.q = h.p, false) AS changed
        FROM step s JOIN (
            SELECT b.w, b.best & 4294967295 AS p, (b.best >> 32)::INTEGER AS r,
                d.p AS gone, d.q, d.u
            FROM (
                SELECT w, min(best) AS best, arg_min(q, best) AS q
                FROM step WHERE best IS NOT NULL AND n < $steps GROUP BY w
            ) b JOIN step d ON d.w = b.w AND d.p = b.q
        ) h ON h.w = s.w AND s.p <> h.gone
    ) x LEFT JOIN merges m ON x.changed AND m.a = x.t AND m.b = x.u
)
"""

# The same for long words: of the pairs of least rank, each second one in a row of
# overlapping pairs, from the left up to the first whose result makes a pair of lower
# rank with a neighbour. One after the other they would be contracted in this order.
RUNS = """
WITH RECURSIVE step(n, w, p, t) AS (
    SELECT 0, w, p, t FROM letters
    UNION ALL
    SELECT n + 1, w, p, CASE WHEN taken THEN r ELSE t END
    FROM (
        SELECT *, coalesce(lag(taken) OVER (PARTITION BY w ORDER BY p), false) AS gone
        FROM (
            SELECT *, hit AND p <= coalesce(
                min(CASE WHEN hit AND trap THEN p END) OVER (PARTITION BY w), p) AS taken
            FROM (
                SELECT x.*, (f.a IS NOT NULL AND f.r < best) OR (g.a IS NOT NULL AND g.r < best)
                    AS trap
                FROM (
                    SELECT *, CASE WHEN coalesce(lag(hit, 2) OVER k, false) THEN best
                        ELSE lag(t) OVER k END AS l
                    FROM (
                        SELECT *, low AND (i - coalesce(max(CASE WHEN low THEN NULL ELSE i END)
                            OVER (PARTITION BY w ORDER BY p ROWS UNBOUNDED PRECEDING), 0)) % 2 = 1
                            AS hit
                        FROM (
                            SELECT *, coalesce(r = best, false) AS low
                            FROM (
                                SELECT s.*, m.r, min(m.r) OVER (PARTITION BY s.w) AS best
                                FROM (
                                    SELECT *, lead(t) OVER k AS u, lead(t, 2) OVER k AS v,
                                        row_number() OVER k AS i
                                    FROM step WINDOW k AS (PARTITION BY w ORDER BY p)
                                ) s LEFT JOIN merges m ON m.a = s.t AND m.b = s.u
                            ) WHERE best IS NOT NULL AND n < $steps
                        )
                    ) WINDOW k AS (PARTITION BY w ORDER BY p)
                ) x
                LEFT JOIN merges f ON x.hit AND f.a = x.l AND f.b = x.best
                LEFT JOIN merges g ON x.hit AND g.a = x.best AND g.b = x.v
            )
        )
    ) WHERE NOT gone
)
"""

LAST = """
SELECT s.w, s.p, s.t, s.n
FROM step s JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) l ON l.w = s.w AND l.n = s.n
"""

DECODED = """
SELECT d.w, count(*) AS n, string_agg(d.t::VARCHAR, ',' ORDER BY d.p) AS ids,
       string_agg(k.spelled, '' ORDER BY d.p) AS spelled
FROM done d JOIN tokens k ON k.t = d.t GROUP BY d.w ORDER BY d.w
"""

Encoded = tuple[bytes, bytes]  # token ids, a comma behind each, and the bytes they stand for


class RankedMerges:
    """Encodes pieces of text by one file of ranks, in an embedded database of the worker."""

    def __init__(self, path: str):
        import duckdb

        with open(path, "rb") as file:
            lines = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        ranks = self.ranks
        pairs = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # Two bytes that stand together in no token are never merged across.
        self.together = np.zeros((256, 256), bool)
        for token in ranks:
            for a, b in zip(token, token[1:], strict=False):
                self.together[a, b] = True
        self.db = duckdb.connect(
            config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""}
        )
        a, b, r = np.array(pairs, np.int32).T
        self._table("merges", {"a": a, "b": b, "r": r})
        names = {"t": np.array(list(ranks.values()), np.int32), "spelled": [k.hex() for k in ranks]}
        self._table("tokens", names)

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _contract(self, query: str, words: list[np.ndarray]) -> None:
        """Add the final tokens of words, numbered from 0, to the table ``done``.

        A query makes so many steps that its rows stay bounded; words that could go
        on start the next one from where they are.
        """
        lengths = np.array([len(x) for x in words], np.int64)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self._table("letters", {
            "w": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
            "p": place.astype(np.int32),
            "t": np.concatenate(words),
        })
        self.db.execute("CREATE OR REPLACE TABLE done (w INTEGER, p INTEGER, t INTEGER)")
        while rows := self.db.execute("SELECT count(*) FROM letters").fetchone()[0]:
            steps = max(4, STEPS_OF_ROWS // rows)
            self.db.execute(f"CREATE OR REPLACE TABLE stopped AS {query} {LAST}", {"steps": steps})
            self.db.execute("INSERT INTO done SELECT w, p, t FROM stopped WHERE n < ?", [steps])
            self.db.execute(
                "CREATE OR REPLACE TABLE letters AS SELECT w, p, t FROM stopped WHERE n >= ?",
                [steps],
            )

    def _encode_words(self, query: str, words: list[np.ndarray]) -> Iterator[Encoded]:
        start, held = 0, 0
        for stop, word in enumerate(words, 1):
            held += len(word)
            if held >= ROWS or stop == len(words):
                self._contract(query, words[start:stop])
                for _, _, ids, spelled in self.db.execute(DECODED).fetchall():
                    yield ids.encode() + b",", bytes.fromhex(spelled)
                start, held = stop, 0

    def encode(self, pieces: list[bytes]) -> list[Encoded]:
        """Tokens of pieces of one byte or more; a piece that is a token stays whole."""
        short: list[np.ndarray] = []
        long: list[np.ndarray] = []
        shares = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                short.append(np.array([rank], np.int32))
            elif len(piece) <= LONG:
                short.append(self.single[np.frombuffer(piece, np.uint8)])
            else:
                letters = np.frombuffer(piece, np.uint8)
                cuts = np.flatnonzero(~self.together[letters[:-1], letters[1:]]) + 1
                parts = np.split(self.single[letters], cuts)
                shares.append((i, len(parts)))
                long += parts
        whole = self._encode_words(LEFTMOST, short)
        parts = self._encode_words(RUNS, long)
        cut = dict(shares)
        return [
            _joined([next(parts) for _ in range(cut[i])]) if i in cut else next(whole)
            for i in range(len(pieces))
        ]

    def decode(self, rows: list[list[int] | None]) -> list[bytes | None]:
        """The bytes of token ids by rows; None for none and for ids not in the file."""
        known = [i for i, ids in enumerate(rows) if ids]
        found: list[bytes | None] = [None if ids is None else b"" for ids in rows]
        if known:
            self._table("done", {
                "w": np.repeat(np.array(known, np.int32), [len(rows[i]) for i in known]),
                "p": np.concatenate([np.arange(len(rows[i]), dtype=np.int32) for i in known]),
                "t": pa.array([t for i in known for t in rows[i]], pa.int64()),
            })
            for i in known:
                found[i] = None
            for i, n, _, spelled in self.db.execute(DECODED).fetchall():
                if n == len(rows[i]):
                    found[i] = bytes.fromhex(spelled)
        return found


def _joined(parts: list[Encoded]) -> Encoded:
    return b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])


class Splitter:
    """Splits text into pieces as the tiktoken library does by a pattern."""

    def __init__(self, pattern: str):
        self.source = pattern
        self.pattern = regex.compile(pattern)
        self.stand_ins: dict[str, str] = {}

    @cached_property
    def probes(self):
        import tiktoken  # asked only about characters that this Python does not know

        one_byte = {bytes([b]): b for b in range(256)}
        return [
            (tiktoken.Encoding(kind, pat_str=kind, mergeable_ranks=one_byte, special_tokens={}), c)
            for kind, c in ((r"\p{L}", "é"), (r"\p{N}", "2"), (r"\s", "\t"))
        ]

    def _stand_in(self, char: str) -> str:
        if char not in self.stand_ins:
            matched = [c for probe, c in self.probes if probe.encode_ordinary(char)]
            self.stand_ins[char] = matched[0] if matched else "!"
        return self.stand_ins[char]

    def __call__(self, text: str) -> list[str]:
        if not has_unknown(text):
            return self.pattern.findall(text)
        # Versions of Unicode differ in what unassigned characters are.
        known = "".join(
            self._stand_in(c) if unicodedata.category(c) == "Cn" else c for c in text
        )
        return [text[m.start() : m.end()] for m in self.pattern.finditer(known)]


class RankedCodec:
    """Whole texts: splits, encodes each distinct piece once, and joins."""

    def __init__(self, path: str, pattern: str):
        self.merges = RankedMerges(path)
        self.split = Splitter(pattern)
        self.known = Remembered(REMEMBERED)

    def _pieces(self, chunk: str) -> list[str]:
        """The pieces of a space and what follows it up to the next."""
        plain = plain_pieces(chunk[1:])
        if plain is None:
            return self.split(chunk)
        return [f" {plain[0]}", plain[1]] if plain[1] else [f" {plain[0]}"]

    def _encoded(self, chunks: list[str], others: list[str], pieces: list[str]) -> list[Encoded]:
        """Encodings of chunks that start with a space, of other text, and of pieces.

        Pieces are remembered, combinations of them are joined anew.
        """
        known = self.known
        parts = [[c] if c in known else self._pieces(c) for c in chunks]
        parts += [self.split(text) for text in others]
        parts += [[piece] for piece in pieces]
        single = {piece for found in parts for piece in found}
        new = list(known.ask(single))
        known.update(zip(new, self.merges.encode([p.encode() for p in new]), strict=True))
        result = [
            known[found[0]] if len(found) == 1 else _joined([known[p] for p in found])
            for found in parts
        ]
        known.shrink()
        return result

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, memoryview, memoryview]]:
        """(number of tokens, ids joined by commas, decoded bytes) of each text.

        A text is cut before its spaces and the distinct parts are numbered in Arrow.
        What stands together in a text then stands together in memory, so ids and bytes
        are digested without a copy. Where a space touches other white space, pieces
        depend on more than one part, and the text is split as a whole.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        values = texts.to_pylist()
        mixed = [bool(MIXED_SPACE.search(t)) or t.endswith(" ") for t in values]
        plain = [i for i, m in enumerate(mixed) if not m and values[i]]
        cut = pc.split_pattern(texts.take(pa.array(plain, pa.int64())), " ")
        offsets = cut.offsets.to_numpy()
        numbered = cut.flatten().dictionary_encode()
        number = numbered.indices.to_numpy().astype(np.int64)
        chunks = [f" {c}" for c in numbered.dictionary.to_pylist()]
        others: dict[str, int] = {}
        for i, at in zip(plain, offsets[:-1].tolist(), strict=True):
            first = values[i].split(" ", 1)[0]
            number[at] = others.setdefault(first, len(chunks) + len(others))
        base = len(chunks) + len(others)
        pieces: dict[str, int] = {}
        rows: list[np.ndarray] = [number[:0]] * len(values)
        for k, i in enumerate(plain):
            rows[i] = number[offsets[k] : offsets[k + 1]]
        for i, m in enumerate(mixed):
            if m:
                rows[i] = np.array(
                    [pieces.setdefault(p, base + len(pieces)) for p in self.split(values[i])]
                )
        used = np.zeros(len(chunks), bool)
        used[number[number < len(chunks)]] = True
        wanted = [c if u else " " for c, u in zip(chunks, used.tolist(), strict=True)]
        encoded = self._encoded(wanted, list(others), list(pieces))
        counts = np.array([e[0].count(b",") for e in encoded], np.int64)
        order = np.concatenate(rows) if rows else number
        ends = np.cumsum([len(r) for r in rows])
        total = np.concatenate([[0], np.cumsum(counts[order])])
        spans = []
        for k in (0, 1):
            taken = pa.array([e[k] for e in encoded], pa.large_binary()).take(pa.array(order))
            _, at, data = taken.buffers()
            view = memoryview(data or b"").cast("B")
            spans.append((np.frombuffer(at, np.int64), view))
        start = 0
        for stop in ends.tolist():
            (at, ids), (place, decoded) = spans
            n = int(total[stop] - total[start])
            yield n, ids[at[start] : at[stop] - (n > 0)], decoded[place[start] : place[stop]]
            start = stop


def _codec(path: str, pattern: str) -> RankedCodec:
    def kind(given: str) -> RankedCodec:
        return RankedCodec(given, pattern)

    kind.__name__ = f"RankedCodec {pattern}"
    return loaded(kind, path)


def encode_ranked(
    docs: DataFrame, text: Column, path: str, pattern: str, with_ids: bool = True
) -> Column:
    """A struct of ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked, ``ids``.

    ``path`` is a file of ranks that every worker finds under that name; each match of
    ``pattern`` is encoded apart, as the tiktoken library's ``encode_ordinary`` does, so
    strings of special tokens are ordinary text. Texts are read whole; null counts as
    empty, and an empty text has no tokens. ``ids_sha256`` digests the decimal ids joined
    by commas, ``decoded_sha256`` the bytes that the ids decode to.
    """
    ship(docs.sparkSession)
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.arrow_udf(f"struct<{kind}, ids array<int>>" if with_ids else f"struct<{kind}>")
    @tidy
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path, pattern)
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for n, ids, decoded in codec.encode(batch):
                columns[0].append(n)
                columns[1].append(hashlib.sha256(ids).hexdigest())
                columns[2].append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    columns[3].append(np.array(bytes(ids).split(b","), np.int32) if n else [])
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
            given = 4 if with_ids else 3
            yield pa.StructArray.from_arrays(arrays[:given], names[:given])

    return encoded(text)


def decode_ranked(docs: DataFrame, ids: Column, path: str, pattern: str) -> Column:
    """The bytes that token ids stand for; null for null ids and for ids not in the file."""
    ship(docs.sparkSession)

    @F.arrow_udf("binary")
    @tidy
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges = _codec(path, pattern).merges
        for batch in batches:
            yield pa.array(merges.decode(batch.to_pylist()), pa.binary())

    return decoded(ids)
