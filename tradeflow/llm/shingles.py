"""Word shingles of whole texts as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# A Mersenne prime and two bases below it for polynomials over bytes; an
# odd base for that modulo 2^64; the increment and the multipliers of the splitmix64
# finalizer.
PRIME = (1 << 31) - 1
PRIME_BASES = (0x5D3A91C7, 0x2B7E1516)
BASE = np.uint64(0x9E6C63D0676A9A99)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
LETTER_VALUES = (LETTERS % np.uint64(PRIME), LETTERS >> np.uint64(33))  # of each polynomial


def powers(n: int) -> np.ndarray:
    """BASE to the powers 0 to n - 1; kept and doubled as texts need."""
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * (_powers[-1:] * BASE)])
    return _powers[:n]


INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_inverse = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _inverse
    while len(_inverse) < n:
        _inverse = np.concatenate([_inverse, _inverse * (_inverse[-1:] * INVERSE)])
    return _inverse[:n]


def words_of(
    texts: list[str | None], blank: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts, stops, index of the text) of the words: A-Z in lower case.

    ``blank`` says for each byte whether it parts words.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    buffer = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    inside = np.empty(len(buffer) + 1, bool)
    inside[0] = False
    if blank is SPACE:  # without a look-up of each byte
        np.logical_and(buffer != 0x20, buffer - np.uint8(0x09) > 4, out=inside[1:])
    else:
        np.logical_not(blank[buffer], out=inside[1:])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = change[::2], change[1::2]
    number = np.diff(np.searchsorted(starts, ends), prepend=0)
    return buffer, starts, stops, np.repeat(np.arange(len(texts)), number)


_tables: dict[int, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` modulo the prime; kept and doubled as texts need."""
    kept = _tables.get(base, np.ones(1, np.uint64))
    while len(kept) < n:
        step = np.uint64(int(kept[-1]) * base % PRIME)
        kept = np.concatenate([kept, kept * step % np.uint64(PRIME)])
    _tables[base] = kept
    return kept[:n]


def spans_hashed(buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes: two polynomials modulo the prime 2^31 - 1.

    Two different spans of n bytes meet for at most n of the prime's bases, and only if
    they do so for both bases is their hash the same. Modulo a power of two there are
    pairs of spans that meet for every base.
    """
    n, prime = len(buffer), np.uint64(PRIME)
    both = np.zeros(len(starts), np.uint64)
    for base, letters in zip(PRIME_BASES, LETTER_VALUES, strict=True):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(letters[buffer] * _table(base, n) % prime, out=total[1:])
        span = (total[stops] - total[starts]) % prime
        inverse = _table(pow(base, -1, PRIME), n + 1)
        both = (both << np.uint64(31)) | (span * inverse[starts] % prime)
    return mix(both ^ mix((stops - starts).astype(np.uint64) * GOLDEN))


_by_place: dict[int, list[np.ndarray]] = {}


def _letters_at(base: int, letters: np.ndarray, place: int) -> np.ndarray:
    """What each byte adds to a polynomial as byte ``place`` of a word; kept."""
    kept = _by_place.setdefault(base, [letters])
    while len(kept) <= place:
        kept.append(kept[-1] * np.uint64(base) % np.uint64(PRIME))
    return kept[place]


def short_hashed(
    buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray, longest: int = 24
) -> np.ndarray:
    """What ``spans_hashed`` gives, word by word: for many spans of few bytes.

    The spans are ordered by length, so that those with a byte at some place are the last
    ones. The few that are longer than ``longest`` go through ``spans_hashed``.
    """
    length = stops - starts
    order = np.minimum(length, longest + 1).astype(np.uint8).argsort(kind="stable")
    begin = starts[order]
    edges = np.cumsum(np.bincount(np.minimum(length, longest + 1), minlength=longest + 2))
    short = int(edges[longest])
    both = [np.zeros(short, np.uint64), np.zeros(short, np.uint64)]
    for place in range(longest):
        first = int(edges[place])  # of the spans of more bytes than that
        if first == short:
            break
        letter = buffer.take(begin[first:short] + place).astype(np.intp)
        for total, base, letters in zip(both, PRIME_BASES, LETTER_VALUES, strict=True):
            total[first:] += _letters_at(base, letters, place).take(letter)
    one, two = (total % np.uint64(PRIME) for total in both)
    size = length[order[:short]].astype(np.uint64)
    result = np.empty(len(starts), np.uint64)
    result[order[:short]] = mix(((one << np.uint64(31)) | two) ^ mix(size * GOLDEN))
    for parts in _near(order[short:], starts, stops):
        low = int(starts[parts[0]])
        span = buffer[low : int(stops[parts].max())]
        result[parts] = spans_hashed(span, starts[parts] - low, stops[parts] - low)
    return result


def _near(spans: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
    """``spans``, in the order of their places, parted where 64 bytes or more lie between."""
    if not len(spans):
        return []
    return np.split(spans, np.flatnonzero(starts[spans[1:]] >= stops[spans[:-1]] + 64) + 1)


def spans_mixed(buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A faster hash of each span, modulo 2^64: for features, where a collision is harmless."""
    total = np.concatenate(
        [np.zeros(1, np.uint64), np.cumsum(LETTERS[buffer] * powers(len(buffer)))]
    )
    hashes = (total[stops] - total[starts]) * inverse_powers(len(buffer) + 1)[starts]
    return mix(hashes + (stops - starts).astype(np.uint64))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of its text): A-Z in lower case, parted by ASCII blanks."""
    buffer, starts, stops, owner = words_of(texts)
    return short_hashed(buffer, starts, stops), owner


def runs_of_words(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each ``k`` words in a row."""
    total = np.zeros(len(hashes) - k + 1, np.uint64)
    for i in range(k):
        total = mix(total + GOLDEN + hashes[i : len(hashes) - k + 1 + i])
    return total


def shingle_sets(texts: Iterable[str | None], k: int) -> Iterator[np.ndarray]:
    """The sorted distinct ``k``-word shingles of each text.

    A text of fewer words is one shingle, its whole word sequence; a text without
    words has none.
    """
    texts = list(texts)
    hashes, owner = word_hashes(texts)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(cuts, cuts[1:], strict=False):
        words = hashes[a:b]
        if b > a:
            yield np.unique(runs_of_words(words, min(k, int(b - a))))
        else:
            yield words[:0]
