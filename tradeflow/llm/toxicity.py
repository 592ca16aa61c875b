"""Toxicity: a recurrent network over words and their characters scores all windows."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import gru
from tradeflow.llm.common import ship, tidy
from tradeflow.llm.merges import slices
from tradeflow.llm.shingles import LETTERS, SPACE, mix, spans_mixed, words_of

# Production settings: at most so many labelled rows of each kind are learned from,
# none of a longer text, so the one task that learns holds a bounded sample.
SAMPLE_ROWS = 1000
SAMPLE_CHARACTERS = 20_000
WINDOW = 32
STRIDE = 24
HIDDEN = 8
DIMENSIONS = 8
TABLE_BITS = 17
ROUNDS = (4, 3, 3)  # passes over the windows; hard ones are mined in between
SEED = 7

# Words end at ASCII blanks and at all other ASCII bytes that are no letter or digit.
PARTS = SPACE.copy()
PARTS[[b for b in range(128) if not chr(b).isalnum()]] = True


class Words:
    """The distinct words of some texts, and where they stand."""

    def __init__(self, texts: list[str | None]):
        buffer, starts, stops, self.owner = words_of(texts, PARTS)
        hashes = spans_mixed(buffer, starts, stops)
        self.hashes, first, self.index = np.unique(
            hashes, return_index=True, return_inverse=True
        )
        self.index = self.index.astype(np.int32)
        self.texts = len(texts)
        self._grams(buffer, starts[first], stops[first])

    def _grams(self, buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        """Rows of the character table: the 3 and 4 bytes in a row of each word, with a
        mark in front of its first byte; of a word of one byte its two signs."""
        rows, words = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for k in range(0, len(starts), 20_000):  # a bounded part of the words at once
            part, word = self._grams_of(buffer, starts[k : k + 20_000], stops[k : k + 20_000])
            rows.append(part)
            words.append(word + np.int32(k))
        self.gram_rows, self.gram_word = np.concatenate(rows), np.concatenate(words)
        self.gram_count = np.bincount(self.gram_word, minlength=len(starts))
        self.gram_first = np.cumsum(self.gram_count) - self.gram_count

    @staticmethod
    def _grams_of(buffer, starts, stops) -> tuple[np.ndarray, np.ndarray]:
        size = stops - starts + 1
        heads = np.cumsum(size) - size
        n = int(size.sum())
        word = np.repeat(np.arange(len(size), dtype=np.int32), size)
        inside = np.arange(n) - heads[word]
        letters = LETTERS[buffer[np.maximum((starts - 1)[word] + inside, 0)]]
        letters[heads] = np.uint64(1)
        left = size[word] - inside
        padded = np.concatenate([letters, np.zeros(3, np.uint64)])
        three = mix(mix(mix(letters) + padded[1 : n + 1]) + padded[2 : n + 2])
        four = mix(three + padded[3 : n + 3])
        shift = np.uint64(64 - TABLE_BITS)
        whole3, whole4 = (left >= 3) | (inside == 0), left >= 4
        rows = np.concatenate(
            [(three[whole3] >> shift).astype(np.int32), (four[whole4] >> shift).astype(np.int32)]
        )
        word = np.concatenate([word[whole3], word[whole4]])
        order = np.argsort(word, kind="stable")
        return rows[order], word[order]

    def word_rows(self) -> np.ndarray:
        return (self.hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def gram_sums(self, table: np.ndarray) -> np.ndarray:
        """For each word the mean of its rows, scaled by the root of their number."""
        if not len(self.hashes):
            return np.zeros((0, table.shape[1]), np.float32)
        sums = np.add.reduceat(table[self.gram_rows], self.gram_first, axis=0)
        return sums / np.sqrt(self.gram_count)[:, None].astype(np.float32)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(words of each window, its text): all texts cut into overlapping windows.

        The last window of a text ends with its last word; a text of fewer words than
        a window is one window, filled up with -1; a text without words has none.
        """
        counts = np.bincount(self.owner, minlength=self.texts)
        begin = (np.cumsum(counts) - counts).astype(np.int32)
        number = np.where(
            counts > 0, np.maximum(0, -(-(counts - WINDOW) // STRIDE)) + 1, 0
        )
        text = np.repeat(np.arange(self.texts), number)
        at = _counting(number) * STRIDE
        at = np.maximum(0, np.minimum(at, counts[text] - WINDOW)).astype(np.int32)
        place = at[:, None] + np.arange(WINDOW, dtype=np.int32)
        inside = place < counts[text][:, None]
        place = np.where(inside, place + begin[text][:, None], 0)
        words = self.index[place] if len(self.index) else place
        return np.where(inside, words, -1), text


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after the other."""
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _inputs(model: dict, words: Words) -> np.ndarray:
    return np.concatenate([model["words"][words.word_rows()], words.gram_sums(model["grams"])], 1)


def _projected(model: dict, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gate inputs of each word for both directions; the last row, of padding, is zero."""
    zero = np.zeros((1, 3 * HIDDEN), np.float32)
    return tuple(
        np.concatenate([inputs @ model[f"{side}_in"] + model[f"{side}_bias"], zero])
        for side in ("ahead", "back")
    )


def window_logits(model: dict, words: Words, windows: np.ndarray) -> np.ndarray:
    ahead, back = _projected(model, _inputs(model, words))
    logits = np.empty(len(windows), np.float32)
    for k in range(0, len(windows), 2048):
        ids = windows[k : k + 2048].T
        logits[k : k + 2048] = gru.forward(model, ahead[ids], back[ids], ids >= 0)
    return logits


def score_texts(model: dict | None, texts: list[str | None]) -> np.ndarray:
    """The probability of the most toxic window of each text; 0 without words."""
    scores = np.zeros(len(texts))
    if model is None:
        return scores
    done = 0
    for part in slices(t or "" for t in texts):
        words = Words(part)
        windows, owner = words.windows()
        if len(windows):
            best = np.full(len(part), -np.inf)
            np.maximum.at(best, owner, window_logits(model, words, windows).astype(np.float64))
            scores[done : done + len(part)] = 1 / (1 + np.exp(-np.clip(best, -700, 700)))
        done += len(part)
    return scores


def _evidence(words: Words, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How much more often words and character runs occur in toxic texts, as log odds."""
    n = len(words.hashes)
    pairs = np.unique(words.owner.astype(np.int64) * n + words.index)
    bad = toxic[pairs // n]
    ratio = (toxic.sum() + 1) / (len(toxic) - toxic.sum() + 1)
    in_bad = np.bincount(pairs[bad] % n, minlength=n)
    in_good = np.bincount(pairs[~bad] % n, minlength=n)
    size = 1 << TABLE_BITS
    tables = []
    for rows, of in ((words.word_rows(), np.arange(n)), (words.gram_rows, words.gram_word)):
        up = np.bincount(rows, in_bad[of], minlength=size)
        down = np.bincount(rows, in_good[of], minlength=size)
        odds = np.log((up + 2) / (down + 2)) - np.log(ratio) * (up + down > 0)
        tables.append(np.clip(np.where(up + down > 0, odds, 0), -4, 4).astype(np.float32))
    return tables[0], tables[1]


def train(texts: list[str | None], toxic: np.ndarray) -> dict | None:
    """A model learned from whole texts and their labels; None if there is one kind only.

    A text is toxic for one of its windows, so the network learns from windows: at
    first the one with most evidence of each text and a random one of each clean
    text, then also the windows that it finds most toxic in clean texts and in
    toxic ones. Embeddings start from the log odds of words and character runs.
    """
    toxic = np.asarray(toxic, bool)
    if not toxic.any() or toxic.all():
        return None
    rng = np.random.default_rng(SEED)
    words = Words(texts)
    windows, owner = words.windows()
    size = 1 << TABLE_BITS
    model = gru.new_params(2 * DIMENSIONS, HIDDEN, rng)
    for name, odds in zip(("words", "grams"), _evidence(words, toxic), strict=True):
        model[name] = rng.normal(0, 0.02, (size, DIMENSIONS)).astype(np.float32)
        model[name] *= (odds != 0)[:, None]
        model[name][:, 0] = odds
    evidence = np.concatenate([_inputs(model, words)[:, [0, DIMENSIONS]].sum(1), [-9]])
    mined = evidence[windows].max(axis=1)
    chosen = [_best(mined, owner, len(texts))]
    clean = np.flatnonzero(~toxic[owner])
    chosen.append(rng.choice(clean, min(len(clean), len(texts)), replace=False))
    adam = gru.Adam(0.01)
    for rounds in ROUNDS:
        picked = np.unique(np.concatenate(chosen))
        label = toxic[owner[picked]]
        share = np.where(label, 0.3 / max(1, label.sum()), 0.7 / max(1, (~label).sum()))
        for _ in range(rounds):
            order = rng.permutation(len(picked))
            for k in range(0, len(order), 256):
                part = order[k : k + 256]
                _learn(model, adam, words, windows[picked[part]], label[part], share[part])
        hardest = _best(window_logits(model, words, windows), owner, len(texts))
        chosen = [chosen[0][~toxic[owner[chosen[0]]]], chosen[1], hardest]
    return model


def _best(score: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """The window with the highest score of each text that has windows."""
    order = np.lexsort((-score, owner))
    return order[np.unique(owner[order], return_index=True)[1]]


def _learn(model, adam, words: Words, windows, label, share) -> None:
    used, ids = np.unique(windows, return_inverse=True)
    ids = ids.reshape(windows.shape).T
    if used[0] == -1:
        used, ids = used[1:], ids - 1
    count = words.gram_count[used]
    gram_of = np.repeat(np.arange(len(used)), count)
    gram_rows = words.gram_rows[np.repeat(words.gram_first[used], count) + _counting(count)]
    root = np.sqrt(words.gram_count[used])[:, None].astype(np.float32)
    word_rows = words.word_rows()[used]
    sums = np.zeros((len(used), DIMENSIONS), np.float32)
    np.add.at(sums, gram_of, model["grams"][gram_rows])
    inputs = np.concatenate([model["words"][word_rows], sums / root], axis=1)
    ahead, back = _projected(model, inputs)
    logits, saved = gru.forward(model, ahead[ids], back[ids], ids >= 0, keep=True)
    d = ((gru.sigmoid(logits) - label) * share * len(share) / share.sum()).astype(np.float32)
    g, d_ahead, d_back = gru.backward(model, saved, d / len(d))
    d_inputs = np.zeros_like(inputs)
    flat = ids.ravel()
    real = flat >= 0
    for side, dp in (("ahead", d_ahead), ("back", d_back)):
        per_word = np.zeros((len(used), 3 * HIDDEN), np.float32)
        np.add.at(per_word, flat[real], dp.reshape(-1, 3 * HIDDEN)[real])
        g[f"{side}_in"] = inputs.T @ per_word
        g[f"{side}_bias"] = per_word.sum(axis=0)
        d_inputs += per_word @ model[f"{side}_in"].T
    rows = {}
    for name, at, part in (
        ("words", word_rows, d_inputs[:, :DIMENSIONS]),
        ("grams", gram_rows, (d_inputs[:, DIMENSIONS:] / root)[gram_of]),
    ):
        rows[name], back_to = np.unique(at, return_inverse=True)
        g[name] = np.zeros((len(rows[name]), DIMENSIONS), np.float32)
        np.add.at(g[name], back_to, part)
    adam.update(model, g, rows)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document is kept from learning."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_characters: int = SAMPLE_CHARACTERS,
) -> dict | None:
    """A model learned from at most ``sample_rows`` toxic and as many clean documents.

    The sample takes labelled ids in hashed order, none that is held out, and leaves
    out texts over ``sample_characters``; a document with several labels is toxic if
    one says so. One task learns from that bounded sample; the driver holds only the
    model. Without documents of both kinds there is no model, and all texts score 0.
    """
    ship(docs.sparkSession)
    node, toxic = F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_toxic")
    known = (
        labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
        .filter(~held_out(id_column))
        .select(node, toxic)
        .groupBy("_id")
        .agg(F.max("_toxic").alias("_toxic"))
    )
    order = F.xxhash64("_id")
    sample = None
    for kind in (1, 0):
        part = known.filter(F.col("_toxic") == kind).orderBy(order, "_id").limit(sample_rows)
        sample = part if sample is None else sample.union(part)
    chosen = (
        docs.select(F.col(id_column).alias("_doc"), F.col(text_column).alias("_text"))
        .filter(F.length("_text") <= sample_characters)
        .join(F.broadcast(sample), F.col("_doc") == F.col("_id"))  # 2 * sample_rows ids
        .select("_id", "_text", "_toxic")
        .orderBy(order, "_id", "_text")
        .limit(2 * sample_rows)
    )
    learned = chosen.coalesce(1).mapInPandas(_train, "model binary").collect()
    return pickle.loads(learned[0]["model"]) if learned else None


@tidy
def _train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = pd.concat([pd.DataFrame({"_text": [], "_toxic": []}), *batches])
    model = train(rows["_text"].tolist(), (rows["_toxic"] == 1).to_numpy(bool))
    if model is not None:
        yield pd.DataFrame({"model": [pickle.dumps(model)]})


def toxicity_score(docs: DataFrame, text: Column, model: dict | None) -> Column:
    """A column with the score of ``text``, from 0 to 1, over all its windows.

    Null and empty texts, and texts without letters or digits, score 0. The model
    has a fixed size, about 9 MB, and is broadcast.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    @tidy
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(score_texts(shared.value, batch.tolist()))

    return scored(text)
