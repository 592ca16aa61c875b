"""Token counts: vocabulary strings that encode alone count as one without merging."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import ship, tidy
from tradeflow.llm.merges import Merges, TwoAges, loaded, plain_pieces

# A run of white space longer than one character that holds a space: only there
# does a piece depend on more than the text between two spaces.
MIXED_SPACE = re.compile(r" \s|\s ")
CACHED_CHARACTERS = 64
CACHE = 150_000


class TokenCounter:
    """Counts the tokens of a text as the tokenizers library does for the same file."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        if self.merges.suffix:
            raise ValueError("a vocabulary with word ends needs the encoder")
        self.alone = self._prove_alone()
        self.pieces = TwoAges(CACHE)
        self.chunks = TwoAges(CACHE)

    def _prove_alone(self) -> set[str]:
        """The pre-tokens that are one token: merging their bytes must give that token.

        A string of the vocabulary need not encode to itself, so each is merged
        once, here. Strings that are not whole UTF-8 cannot be pre-tokens.
        """
        back = {letter: byte for byte, letter in self.merges.letters.items()}
        alone = set()
        for spelled, token in self.merges.vocab.items():
            if self.merges.merge(self.merges.symbols(spelled)) == [token]:
                try:
                    alone.add(bytes(back[c] for c in spelled).decode("utf-8"))
                except UnicodeDecodeError:
                    continue
        return alone

    def piece(self, piece: str) -> int:
        if piece in self.alone:
            return 1
        count = self.pieces.find(piece)
        if count is None:
            m = self.merges
            count = len(m.merge(m.symbols(m.spell(piece))))
            if len(piece) <= CACHED_CHARACTERS:
                self.pieces.put(piece, count)
        return count

    def _whole(self, text: str) -> int:
        return sum(map(self.piece, self.merges.pieces(text)))

    def _chunk(self, chunk: str) -> int:
        """Tokens of a space and the characters up to the next space."""
        count = self.chunks.old.get(chunk)
        if count is None:
            plain = plain_pieces(chunk)
            if plain is None:
                count = self._whole(f" {chunk}")
            else:
                count = self.piece(f" {plain[0]}") + (self.piece(plain[1]) if plain[1] else 0)
        if len(chunk) <= CACHED_CHARACTERS:
            self.chunks.put(chunk, count)
        return count

    def _segment(self, text: str) -> int:
        if MIXED_SPACE.search(text) or text.endswith(" "):
            return self._whole(text)
        first, *rest = text.split(" ")
        known = self.chunks
        total = self._whole(first)
        for chunk in rest:
            count = known.get(chunk)
            total += self._chunk(chunk) if count is None else count
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(
            1 if special else self._segment(part) for special, part in self.merges.segments(text)
        )


def count_tokens(docs: DataFrame, text: Column, tokenizer_path: str) -> Column:
    """A column with the number of tokens of ``text``; null and empty texts have none.

    ``tokenizer_path`` is a vocabulary file that every worker finds under that name.
    Special strings inside a text count as one token each, as is the library's
    default; nothing is added, cut or padded. Texts of any length are read whole.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    @tidy
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = loaded(TokenCounter, tokenizer_path)
        for batch in batches:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    return counted(text)
