"""BPE encoding and decoding: speculate with greedy longest matches, then verify."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import ship, tidy
from tradeflow.llm.merges import Merges, Remembered, has_unknown, loaded, plain_pieces, slices

# Words that a worker remembers: 300 bytes each.
REMEMBERED = 100_000
SLICE = 1_500_000
PAIRS = 2_000_000


class Codec:
    """Encodes and decodes as the tokenizers library does for a file with word ends.

    A sequence of tokens is the exact encoding of a word if and only if each token
    encodes alone to itself and each two neighbours are the exact encoding of their
    concatenation. So tokens that do not encode to themselves are never proposed,
    verdicts on pairs are kept, and all pairs of a batch of new words are looked up
    at once. Words with a pair that fails are merged exactly.
    """

    def __init__(self, path: str):
        self.merges = Merges(path)
        if not self.merges.suffix:
            raise ValueError("a vocabulary without word ends is not handled here")
        self.suffix = self.merges.suffix
        self.middle: dict[str, int] = {}
        self.last: dict[str, int] = {}
        for spelled, token in self.merges.vocab.items():
            if self.merges.merge(self.symbols_of(token)) == [token]:
                if spelled.endswith(self.suffix) and len(spelled) > len(self.suffix):
                    self.last[spelled.removesuffix(self.suffix)] = token
                else:
                    self.middle[spelled] = token
        # How long the tokens are that start with the same three letters.
        self.reach: dict[str, int] = {}
        for piece in [*self.middle, *self.last]:
            start = piece[:3]
            self.reach[start] = max(self.reach.get(start, 0), len(piece))
        self.pair_codes = np.empty(0, np.int64)
        self.pair_fits = np.empty(0, bool)
        self.words = Remembered(REMEMBERED)
        self.exact_words = 0

    def symbols_of(self, token: int) -> list[int]:
        """The single-letter tokens that a token is made of."""
        name, vocab = self.merges.names[token], self.merges.vocab
        if name.endswith(self.suffix) and len(name) > len(self.suffix):
            body = name.removesuffix(self.suffix)
            return [*(vocab[c] for c in body[:-1]), vocab[body[-1] + self.suffix]]
        return [vocab[c] for c in name]

    def propose(self, spelled: str) -> list[int]:
        """Greedy longest match from the left."""
        ids, i, n = [], 0, len(spelled)
        middle, last, reach = self.middle.get, self.last.get, self.reach.get
        while True:
            far = i + reach(spelled[i : i + 3], 2)
            if far >= n:
                token = last(spelled[i:])
                if token is not None:
                    ids.append(token)
                    return ids
                far = n - 1
            for j in range(far, i, -1):
                token = middle(spelled[i:j])
                if token is not None:
                    ids.append(token)
                    i = j
                    break

    def _fits(self, codes: np.ndarray) -> np.ndarray:
        """Whether the pairs a * 2^32 + b stand side by side in an exact encoding."""
        unique, back = np.unique(codes, return_inverse=True)
        at = np.searchsorted(self.pair_codes, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.pair_codes)
        known[inside] = self.pair_codes[at[inside]] == unique[inside]
        fits = np.zeros(len(unique), bool)
        fits[known] = self.pair_fits[at[known]]
        for k in np.flatnonzero(~known):
            a, b = int(unique[k] >> 32), int(unique[k] & 0xFFFFFFFF)
            fits[k] = self.merges.merge([*self.symbols_of(a), *self.symbols_of(b)]) == [a, b]
        if not known.all():
            if len(self.pair_codes) > PAIRS:
                self.pair_codes, self.pair_fits = unique, fits
            else:
                codes = np.concatenate([self.pair_codes, unique[~known]])
                order = np.argsort(codes, kind="stable")
                self.pair_codes = codes[order]
                self.pair_fits = np.concatenate([self.pair_fits, fits[~known]])[order]
        return fits[back]

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        """The token ids of words (pre-tokens), all verified."""
        spelled = [self.merges.spell(w) for w in words]
        proposed = [self.propose(s) for s in spelled]
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for ids in proposed for t in ids), np.int64, int(lengths.sum()))
        if len(flat) < 2:
            return proposed
        owner = np.repeat(np.arange(len(proposed)), lengths)
        side = owner[1:] == owner[:-1]
        fits = self._fits((flat[:-1] << 32 | flat[1:])[side])
        for k in np.unique(owner[1:][side][~fits]):
            proposed[k] = self.merges.merge(self.merges.symbols(spelled[k]))
            self.exact_words += 1
        return proposed

    def normalised(self, text: str) -> str:
        """Composed characters and lower case, character by character."""
        if not text.isascii():
            if has_unknown(text):
                return self.merges.library.normalizer.normalize_str(text)
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # no special form at the end of a word
        return text.lower()

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        for part in slices((t or "" for t in texts), SLICE):
            yield from self._encode_slice(part)

    def _encode_slice(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Texts are cut at blanks and the distinct parts numbered in Arrow; what stands
        together in a text then stands together in memory and is copied out at once.

        Special strings part a text, and stand for their token.
        """
        rows, owner, special = [], [], {}
        for i, text in enumerate(texts):
            for is_special, part in self.merges.segments(text):
                if is_special:
                    special[len(rows)] = part
                rows.append("" if is_special else self.normalised(part))
                owner.append(i)
        numbered = pc.ascii_split_whitespace(pa.array(rows, pa.large_string()))
        at = numbered.offsets.to_numpy()
        values = numbered.flatten().dictionary_encode()
        order = values.indices.to_numpy().astype(np.int64)
        chunks = values.dictionary.to_pylist()
        encoded = self._encode_chunks(chunks)
        for row, name in special.items():
            # The empty part of its row stands for the special string.
            order[at[row]] = len(encoded)
            encoded.append((self.merges.special[name].to_bytes(4, "little"), f"{name} ".encode()))
        columns = []
        for k in (0, 1):
            taken = pa.array([e[k] for e in encoded], pa.large_binary()).take(pa.array(order))
            _, cuts, data = taken.buffers()
            columns.append((np.frombuffer(cuts, np.int64), memoryview(data or b"").cast("B")))
        stops = at[np.searchsorted(owner, np.arange(len(texts)), side="right")]
        start = 0
        (ids_at, ids), (text_at, decoded) = columns
        for stop in stops.tolist():
            yield (
                bytes(ids[ids_at[start] : ids_at[stop]]),
                bytes(decoded[text_at[start] : text_at[stop]]).removesuffix(b" "),
            )
            start = stop

    def _encode_chunks(self, chunks: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids, and decoded text with a space behind each token, of parts without blanks.

        Words are remembered; parts of several words are joined anew.
        """
        known = self.words
        parts = [
            [c]
            if c in known
            else [p for p in plain if p]
            if (plain := plain_pieces(c))
            else self.merges.pieces(c)
            for c in chunks
        ]
        new = list(known.ask({word for found in parts for word in found}))
        names = self.merges.names
        for word, ids in zip(new, self.encode_words(new), strict=True):
            text = "".join([f"{names[i]} " for i in ids])
            known[word] = (np.array(ids, "<u4").tobytes(), text.encode())
        result = []
        for found in parts:
            entries = [known[word] for word in found]
            result.append(
                entries[0]
                if len(entries) == 1
                else (b"".join([e[0] for e in entries]), b"".join([e[1] for e in entries]))
            )
        known.shrink()
        return result

    def decode(self, ids: Sequence[int]) -> str:
        """The names of the tokens; the file has no decoder, so spaces part them."""
        names = self.merges.names
        return " ".join(names[i] for i in ids if i in names)


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def encode_texts(
    docs: DataFrame,
    text: Column,
    tokenizer_path: str,
    with_ids: bool = True,
    remembered: int = REMEMBERED,
) -> Column:
    """A struct column (n_tokens, ids, ids_sha256, decoded_sha256) of ``text``.

    ``ids`` is an array of token ids; ``ids_sha256`` digests them as little-endian
    unsigned 32-bit integers and ``decoded_sha256`` the text they decode to, in UTF-8.
    Without ``with_ids`` the ids stay with the worker. Null counts as empty and has no
    tokens. Special strings in a text become their special token. ``tokenizer_path``
    must exist on every worker, which keeps the encodings of ``remembered`` words. Texts
    of any length are encoded whole; other columns never leave the JVM.
    """
    ship(docs.sparkSession)
    ids = "ids array<int>, " if with_ids else ""

    @F.pandas_udf(f"n_tokens long, {ids}ids_sha256 string, decoded_sha256 string")
    @tidy
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = loaded(Codec, tokenizer_path)
        codec.words.limit = remembered
        for batch in batches:
            rows = [
                (b, _sha256(b), _sha256(d))
                for b, d in codec.encode_batch(batch)
            ]
            columns = {
                "n_tokens": [len(b) // 4 for b, _, _ in rows],
                "ids": [np.frombuffer(b, "<i4") for b, _, _ in rows] if with_ids else None,
                "ids_sha256": [i for _, i, _ in rows],
                "decoded_sha256": [d for _, _, d in rows],
            }
            yield pd.DataFrame({k: v for k, v in columns.items() if v is not None})

    return encoded(text)


def decode_ids(docs: DataFrame, ids: Column, tokenizer_path: str) -> Column:
    """A column with the decoded text of an array of token ids; null stays null."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    @tidy
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = loaded(Codec, tokenizer_path)
        for batch in batches:
            yield pd.Series(
                [None if x is None else codec.decode([int(i) for i in x]) for x in batch],
                dtype=object,
            )

    return decoded(ids)
