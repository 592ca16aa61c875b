"""Byte-pair merges of a public vocabulary file: the exact rules, and a bounded cache."""

from __future__ import annotations

import gc
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property

import regex

# The pre-token patterns of the two kinds of vocabulary file.
BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Below this character all versions of Unicode agree on letters and numbers.
SETTLED = "\u0530"

NONE = 1 << 62
MASK = (1 << 20) - 1
# ASCII marks that are neither letter, digit nor apostrophe.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def plain_pieces(chunk: str) -> tuple[str, str] | None:
    """(letters, marks) of a chunk that is letters and then marks, else None.

    Any pattern of the files here makes one piece of each. An apostrophe in front
    could start a contraction, so it is no mark.
    """
    if chunk.isalpha():
        return chunk, ""
    letters = chunk.rstrip(MARKS)
    return (letters, chunk[len(letters) :]) if letters.isalpha() else None


def has_unknown(text: str) -> bool:
    """Whether a character of the text is unassigned in this Python's Unicode tables."""
    if text.isascii() or max(text) < SETTLED:
        return False
    return any(unicodedata.category(c) == "Cn" for c in set(text))


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a vocabulary file.

    Printable Latin-1 characters stand for themselves; the other bytes take the
    characters from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


class Merges:
    """The vocabulary and merge rules of one file, and exact merging with them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.path = path
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.names = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.names.update({i: t for t, i in self.special.items()})
        # Rules by the pair as one number; a rule is its rank and result as one number.
        self.rules: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            whole = a.removesuffix(self.suffix) + b if self.suffix else a + b
            pair = self.vocab[a] << 20 | self.vocab[b]
            self.rules.setdefault(pair, rank << 20 | self.vocab[whole])
        self.letters = byte_letters()
        self.pattern = regex.compile(WORD_PATTERN if self.suffix else BYTE_PATTERN)
        self.split_special = (
            re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
            if self.special
            else None
        )

    def spell(self, piece: str) -> str:
        """A piece of text in the letters of the vocabulary."""
        if piece.isascii() and piece.isprintable() and " " not in piece:
            return piece
        return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)

    def symbols(self, spelled: str) -> list[int]:
        ids = [self.vocab[c] for c in spelled]
        if self.suffix and spelled:
            ids[-1] = self.vocab[spelled[-1] + self.suffix]
        return ids

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the rule of least rank, leftmost first, until none applies."""
        if len(ids) > 48:
            return self._merge_long(ids)
        rule = self.rules.get
        ids = list(ids)
        found = [rule(a << 20 | b, NONE) for a, b in zip(ids, ids[1:], strict=False)]
        while found:
            best = min(found)
            if best == NONE:
                break
            i = found.index(best)
            ids[i] = whole = best & MASK
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = rule(ids[i - 1] << 20 | whole, NONE)
            if i < len(found):
                found[i] = rule(whole << 20 | ids[i + 1], NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over linked neighbours, for pieces of any length."""
        ids = list(ids)
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def propose(i: int) -> None:
            j = after[i]
            if j < n and (rule := self.rules.get(ids[i] << 20 | ids[j])) is not None:
                heapq.heappush(heap, (rule >> 20, i, ids[i], ids[j], rule & MASK))

        for i in range(n - 1):
            propose(i)
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = whole, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                propose(before[i])
            propose(i)
        return [x for x in ids if x >= 0]

    @cached_property
    def library(self):
        from tokenizers import Tokenizer  # only texts with rare characters need it

        return Tokenizer.from_file(self.path)

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text.

        Versions of Unicode differ in which rare characters are letters. A text with
        a character unknown to this Python is split by the library itself.
        """
        if has_unknown(text):
            found = self.library.pre_tokenizer.pre_tokenize_str(text)
            return [text[a:b] for _, (a, b) in found]
        return self.pattern.findall(text)

    def segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is a special token, text) of the parts of a text."""
        if self.split_special is None:
            yield False, text
            return
        for k, part in enumerate(self.split_special.split(text)):
            if part:
                yield k % 2 == 1, part


class TwoAges(dict):
    """A cache of bounded size: when the young half is full it becomes the old half."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        self.old: dict = {}

    def find(self, key):
        return self[key] if key in self else self.old.get(key)

    def put(self, key, value):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value


class Remembered(dict):
    """Encodings by text. When there are too many, those not asked for again go."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        self.again: set[str] = set()

    def ask(self, names: set[str]) -> set[str]:
        """The names that are not known; the others are noted as asked for again."""
        new = names - self.keys()
        self.again |= names - new
        return new

    def shrink(self) -> None:
        if len(self) > self.limit:
            kept = {k: self[k] for k in self.again}
            self.clear()
            if len(kept) <= self.limit // 2:
                self.update(kept)
            self.again = set()


_loaded: dict = {}


def loaded(kind: type, path: str):
    """One engine of a kind and file for a worker process, kept between its tasks."""
    key = (kind.__module__, kind.__name__, path)
    if key not in _loaded:
        _loaded.clear()  # a worker holds the tables of one engine at a time
        _loaded[key] = kind(path)
        gc.freeze()  # the tables stay: the collector need not walk them again
    return _loaded[key]


def slices(texts: Iterable[str], characters: int = 500_000) -> Iterator[list[str]]:
    """Texts in lists of about so many characters; a longer text is alone in its list."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > characters:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


