"""The numpy and pure Python parts, against brute force or the public library."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tradeflow.llm import gru, toxicity
from tradeflow.llm.bpe import Codec
from tradeflow.llm.lines import winnow
from tradeflow.llm.mixing import pfair_slots, whole_weights
from tradeflow.llm.passages import (
    Matcher,
    _contexts,
    _windows,
    compact_windows,
    matched_passage,
    shingle_sequences,
)
from tradeflow.llm.setsketch import likely_jaccard, merge_registers, registers
from tradeflow.llm.shingles import (
    GOLDEN,
    LETTERS,
    PRIME,
    PRIME_BASES,
    mix,
    shingle_sets,
    short_hashed,
    spans_hashed,
    word_hashes,
    words_of,
)
from tradeflow.llm.token_counts import TokenCounter
from tradeflow.llm.vectors import bucket_codes

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts():
    rng = random.Random(3)
    parts = list("  \n\t'sx.e1ÀéßΣσİǺ漢　\x1c\x85👍​Ᲊ՘") + [
        "<|endoftext|>", "<|startoftext|>", "the", "ing", " ", "!!", "ΑΣ", "'ll",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    letters = "etaoinshrdl"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    return [*texts, "", "a" * 5000, "!?" * 3000, "ab " * 1000, " " * 3000, "x" + " " * 500 + "y"]


def test_codec_equals_the_library():
    texts, codec, library = odd_texts(), Codec(WORD_FILE), Tokenizer.from_file(WORD_FILE)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for (ids, decoded), want in zip(codec.encode_batch([*texts, None]), [*expected, []], strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded.decode() == library.decode(want, skip_special_tokens=False)
    assert codec.exact_words > 0  # some words fail the check of their pairs


def test_counter_equals_the_library():
    texts, counter, library = odd_texts(), TokenCounter(BYTE_FILE), Tokenizer.from_file(BYTE_FILE)
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [counter.count(t) for t in texts] == expected
    assert counter.count(None) == 0


def test_shortcut_strings_are_single_tokens():
    library = Tokenizer.from_file(BYTE_FILE)
    some = sorted(TokenCounter(BYTE_FILE).alone)[::50]
    assert all(len(e.ids) == 1 for e in library.encode_batch(some, add_special_tokens=False))


@pytest.mark.parametrize("n, width", [(10, 8), (60, 8), (300, 46), (7, 8)])
def test_compact_windows_are_the_long_nodes_of_the_tree(n, width):
    v = np.random.default_rng(n).integers(1, 2**62, n).astype(np.uint64) * np.uint64(2)
    v = np.concatenate([v, v[: n // 2], v])  # ties and a second text
    cuts = np.array([0, n + n // 2, len(v)])
    want = set()
    for a, b in zip(cuts, cuts[1:], strict=False):
        for c in range(a, b):
            low, high = c, c
            while low > a and v[low - 1] > v[c]:
                low -= 1
            while high < b - 1 and v[high + 1] >= v[c]:
                high += 1
            if high - low + 1 >= width:
                want.add((c, low, high))
    assert set(zip(*(x.tolist() for x in compact_windows(v, cuts, width)), strict=True)) == want


def test_passage_with_an_edit_is_matched():
    words = [f"w{i}" for i in range(120)]
    late = ["x"] * 30 + words[:70] + ["edited"] + words[71:] + ["y"] * 30
    runs, cuts = shingle_sequences([" ".join(words), " ".join(late)])
    early, late_runs = runs[: cuts[1]], runs[cuts[1] :]
    found = matched_passage(early, late_runs, (20, 0, 115, 50, 30, 145), 46, 0.8)
    assert found == (30, 146, 0, 116)
    assert matched_passage(early, late_runs[:40], (5, 0, 115, 35, 0, 39), 46, 0.8) is None


def _plain_match(early, late, seed, shortest, similarity):
    """The match of one seed by trying every place and every stretch."""
    a, a_left, a_right, b, b_left, b_right = seed
    back = min(2 * (a - a_left) + 8, b - b_left)
    ahead = min(2 * (a_right - a) + 8, b_right - b)
    ratio = 2 * similarity / (1 + similarity)
    where = []
    for t in range(-back, ahead + 1):
        drift, due = max(abs(t) >> 2, 8), min(max(a + t, a_left), a_right)
        near = range(max(a + t - drift, a_left), min(a + t + drift, a_right) + 1)
        spots = [p for p in near if early[p] == late[b + t]]
        where.append(min(spots, key=lambda p: (abs(p - due), p < due), default=None))
    score = [-ratio / (1 - ratio) if p is None else 1.0 for p in where]
    left, right = (np.cumsum([0, *x]) for x in (score[:back][::-1], score[back:]))
    long = [
        (down + up, -down, up)
        for down in range(len(left))
        for up in range(len(right))
        if right[up] >= -left[down]
    ]
    for down, up in ((-max(long)[1], max(long)[2]), (left.argmax(), right.argmax())):
        own = [t for t in range(-down, up) if where[back + t] is not None]
        if down + up < shortest or not own:
            continue
        spots = [where[back + t] for t in own]
        found = b + own[0], b + own[-1] + 1, min(spots), max(spots) + 1
        x, y = {*late[found[0] : found[1]].tolist()}, {*early[found[2] : found[3]].tolist()}
        if min(found[1] - found[0], found[3] - found[2]) < shortest:
            continue
        if len(x & y) >= similarity * len(x | y):
            return found
    return None


def test_seeds_of_many_pairs_match_as_each_does_alone():
    rng = np.random.default_rng(3)
    early = [rng.integers(0, kinds, 260).astype(np.uint64) for kinds in (10**6, 10**6, 40, 900)]
    late, of, seeds = [], [], []
    for k in range(40):
        text = k % len(early)
        own = rng.integers(0, 10**6, 240).astype(np.uint64)
        a, long = int(rng.integers(0, 150)), int(rng.integers(20, 100))
        at = int(rng.integers(0, 140))
        own[at : at + long] = early[text][a : a + long]
        wrong = rng.integers(at, at + long, int(rng.integers(0, 8)))
        own[wrong] = rng.integers(0, 10**6, len(wrong)).astype(np.uint64)
        late.append(np.delete(own, wrong[: len(wrong) // 3]))
        of.append(text)
        for _ in range(6):
            step = int(rng.integers(0, long))
            ends = rng.integers(0, 120, 4).tolist()
            b, place = at + step, a + step
            seeds.append((
                k, b, max(0, b - ends[0]), min(len(late[k]) - 1, b + ends[1]),
                place, max(0, place - ends[2]), min(259, place + ends[3]),
            ))
    text, *_ = turned = np.array(seeds).T
    turned = np.array(turned[1:]).T
    matcher = Matcher(early, 46, 0.8)
    matcher.follow(late, of, [None] * len(late))
    able, *reach = matcher.able(text, turned)
    found = {}
    for number, *candidate in matcher.candidates(text[able], turned[able], *reach, held=700):
        k = int(able[number])
        found[k] = matcher.match(int(text[k]), turned[k].tolist(), *candidate)
    plain = [
        _plain_match(early[of[k]], late[k], (*seed[3:], *seed[:3]), 46, 0.8)
        for k, *seed in seeds
    ]
    assert [found.get(k) for k in range(len(seeds))] == plain
    assert 20 < sum(p is not None for p in plain) < len(plain) - 20
    # What cannot match is hardly looked at further.
    assert len(found) < 2 * sum(p is not None for p in plain)


def test_words_hashed_one_by_one_have_the_hash_of_their_span():
    rng = np.random.default_rng(21)
    texts = ["", " \t", "a", "x" * 24 + " " + "x" * 25 + " y " + "Ü" * 300 + " z" * 40]
    for size in (3, 40, 900):
        texts.append("".join(rng.choice(list("aB \n\x00éβ"), size, p=[0.4, 0.2, 0.1, 0.05, 0.05, 0.1, 0.1])))
    for some in (texts, texts[::-1], [], ["", ""]):
        buffer, starts, stops, owner = words_of(some)
        words = [w for t in some for w in t.encode().lower().split()]
        assert [buffer[x:y].tobytes() for x, y in zip(starts, stops, strict=True)] == words
        assert owner.tolist() == [k for k, t in enumerate(some) for _ in t.encode().split()]
        hashes = short_hashed(buffer, starts, stops)
        assert (hashes == spans_hashed(buffer, starts, stops)).all()


def test_windows_and_contexts_of_a_document_are_one_row_a_key():
    rng = np.random.default_rng(22)
    some = [f"w{k}" for k in rng.integers(0, 300, 200)]
    texts = [" ".join(["junk"] * 400), " ".join(some + some[:120]), "short", None]
    batch = pa.RecordBatch.from_pydict({"doc": [5, 6, 7, 8], "text": texts})
    found = pa.Table.from_batches(_windows(50, 3)(iter([batch]))).to_pylist()
    keys = [(r["key"], r["doc"]) for r in found]
    assert len(set(keys)) == len(keys)
    own = {5: [], 6: []}
    for r in found:
        triples = np.frombuffer(r["windows"], np.int32).reshape(-1, 3)
        assert (np.diff(triples[:, 0]) > 0).all()
        own[r["doc"]] += [tuple(x) for x in triples.tolist()] if r["whole"] else []
    for doc, text in ((5, texts[0]), (6, texts[1])):
        runs, cuts = shingle_sequences([text])
        values = mix(runs ^ GOLDEN)
        want = set(zip(*(x.tolist() for x in compact_windows(values, cuts, 46)), strict=True))
        assert len(own[doc]) == len(want) and set(own[doc]) == want
    assert len([r for r in found if r["doc"] == 5]) == 3 and len(own[5]) == 351

    whole = [[r["windows"] for r in found if r["doc"] == doc and r["whole"]] for doc in (5, 6)]
    held = pa.RecordBatch.from_pydict(
        {"doc": [5, 6], "windows": whole, "spans": [[0, 400], None], "text": texts[:2]},
        schema=pa.schema([
            ("doc", pa.int64()), ("windows", pa.list_(pa.binary())),
            ("spans", pa.list_(pa.int32())), ("text", pa.string()),
        ]),
    )
    rows = pa.Table.from_batches(_contexts(50, 3)(iter([held]))).to_pylist()
    keys = [(r["one"], r["two"], r["doc"]) for r in rows]
    assert len(set(keys)) == len(keys)
    runs = {5: {}, 6: {}}
    for doc, text in ((5, texts[0]), (6, texts[1])):
        w = text.split()
        for k in range(len(w) - 49):
            runs[doc].setdefault(tuple(w[k : k + 50]), []).append(k)
    for doc, plain in runs.items():
        first = {}
        for r in rows:
            centre, left, right = np.frombuffer(r["first"], np.int32).tolist()
            open_ = np.frombuffer(r["windows"], np.int32).reshape(-1, 3)
            if r["doc"] == doc and (centre, right - left) == (left, 45):
                first[centre] = (r["n"], open_[:, 0].tolist())
        for at in plain.values():
            assert first[at[0]] == (len(at), [] if doc == 5 else at)


def test_seeds_within_a_text_whose_source_would_overlap_are_left():
    text = np.tile(np.arange(30, dtype=np.uint64), 12)
    matcher = Matcher([text], 46, 0.8)
    matcher.follow([text[30:]], [0], [30])
    seeds = np.array([(100, 0, 250, a, 10, 300) for a in (130, 120, 70)])  # 0, 10, 60 words apart
    text = np.zeros(len(seeds), int)
    able, *reach = matcher.able(text, seeds)
    assert [int(able[k]) for k, *_ in matcher.candidates(text[able], seeds[able], *reach)] == [2]


def test_winnowing_gives_every_window_its_minimum():
    h = np.array([5, 3, 3, 9, 1, 7, 7, 2], np.uint64)
    marks = winnow(h, 3)
    starts = {s: at for at, low, high in marks for s in range(low, high + 1)}
    assert sorted(starts) == list(range(6))
    for s, at in starts.items():
        assert s <= at < s + 3 and h[at] == h[s : s + 3].min()
    assert winnow(h[:2], 3) == []


def test_shingles_follow_the_definition():
    texts = ["A b\tC d e", "a b c", "", None, "x x x x x x", " É é "]
    sets = [len(s) for s in shingle_sets(texts, 4)]
    assert sets == [2, 1, 0, 0, 1, 1]
    lower, upper = shingle_sets(["a b c d", "A B C D"], 4)
    assert lower.tolist() == upper.tolist()


@pytest.mark.parametrize("jaccard", [0.5, 0.8, 0.95])
def test_setsketch_estimates_and_merges(jaccard):
    rng = np.random.default_rng(1)
    n, guesses = 400, []
    both = round(2 * n * jaccard / (1 + jaccard))
    for _ in range(30):
        u = rng.integers(0, 2**63, 2 * n - both).astype(np.uint64)
        a, b = np.unique(u[:n]), np.unique(u[n - both :])
        r = registers([a, b, np.union1d(a, b)])
        assert (merge_registers(r[0], r[1]) == r[2]).all()
        guesses.append(
            likely_jaccard(
                np.array([(r[0] > r[1]).sum()]), np.array([(r[0] < r[1]).sum()]), r.shape[1],
                np.array([n]), np.array([n]),
            )[0]
        )
    assert abs(np.mean(guesses) - jaccard) < 0.03
    assert registers([np.zeros(0, np.uint64)]).max() == 0


def test_cross_polytope_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    near = 0.9 * a + np.sqrt(1 - 0.81) * b
    for hashes in (1, 2, 3):
        u, v = (bucket_codes(x, hashes, 5 * hashes, 4) for x in (a, near))
        met = (u[:, :, :, None] == v[:, :, None, :]).any(axis=(1, 2, 3))
        assert met.mean() > 0.99


@pytest.mark.parametrize(
    "blocks, weights",
    [
        ([700, 700, 600], [1, 1, 1]),
        ([20_000, 1300, 5], [5000, 300, 1]),
        ([60, 0, 7, 90, 1], [0.3, 2.0, 1e-3, 7.7, 5.0]),
        ([6700, 6700, 6600], [1 / 3, 1 / 3, 1 / 3]),
        ([5], [2.5]),
        ([], []),
    ],
)
def test_no_source_is_a_block_off_its_weight(blocks, weights):
    whole = whole_weights(weights)
    left, slot = list(blocks), 0
    done = [0] * len(blocks)
    schedule = iter(pfair_slots(blocks, whole))
    while any(left):  # a stretch: until a source runs out
        active = [i for i, n in enumerate(left) if n]
        total, given = sum(whole[i] for i in active), dict.fromkeys(active, 0)
        t = 0
        while all(given[i] < left[i] for i in active):
            i, block, release, deadline, at = next(schedule)
            assert block == done[i] + given[i] and at == slot + t and release <= at < deadline
            assert release == slot + given[i] * total // whole[i]
            given[i] += 1
            t += 1
            assert all(abs(given[k] * total - t * whole[k]) < total for k in active)
        slot += t
        for i, n in given.items():
            left[i] -= n
            done[i] += n
    assert next(schedule, None) is None


def test_schedule_equals_brute_force():
    """Every slot by a search of all sources for the earliest deadline among those released."""
    blocks, weights = [40, 25, 60, 9], whole_weights([0.5, 0.25, 1.1, 0.05])
    left, done, found, start = list(blocks), [0] * 4, [], 0
    while any(left):
        active, given, t = [i for i in range(4) if left[i]], [0] * 4, 0
        total = sum(weights[i] for i in active)
        while all(given[i] < left[i] for i in active):
            released = [i for i in active if given[i] * total // weights[i] <= t]
            i = min(released, key=lambda i: (-(-(given[i] + 1) * total // weights[i]), i))
            found.append((i, done[i] + given[i], start + t))
            given[i] += 1
            t += 1
        start += t
        left = [n - g for n, g in zip(left, given, strict=True)]
        done = [n + g for n, g in zip(done, given, strict=True)]
    assert [(i, j, s) for i, j, _, _, s in pfair_slots(blocks, weights)] == found


def test_gradients_of_the_network():
    rng = np.random.default_rng(2)
    p = {k: v.astype(np.float64) for k, v in gru.new_params(5, 3, rng).items()}
    ahead, back = rng.normal(size=(2, 6, 4, 9)).astype(np.float32)
    filled = np.ones((6, 4), bool)
    filled[4:, 1] = False
    d = rng.normal(size=4)
    _, saved = gru.forward(p, ahead, back, filled, keep=True)
    g, d_ahead, _ = gru.backward(p, saved, d)
    for name in g:
        flat, at = p[name].ravel(), 0
        old = flat[at]
        flat[at] = old + 1e-2
        up = gru.forward(p, ahead, back, filled) @ d
        flat[at] = old - 1e-2
        down = gru.forward(p, ahead, back, filled) @ d
        flat[at] = old
        assert np.isclose(g[name].ravel()[at], (up - down) / 2e-2, rtol=0.05, atol=2e-3), name
    ahead[2, 0, 1] += 0.01
    up = gru.forward(p, ahead, back, filled) @ d
    ahead[2, 0, 1] -= 0.02
    assert np.isclose(d_ahead[2, 0, 1], (up - gru.forward(p, ahead, back, filled) @ d) / 0.02,
                      rtol=0.05, atol=2e-3)


def test_toxicity_learns_words_and_stems():
    rng = random.Random(5)
    plain = [f"{a}{b}" for a in ("tor", "mel", "sin", "gar", "lu") for b in ("a", "en", "ot", "is")]

    def text(bad):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        if bad:
            words[rng.randrange(len(words))] = "vex" + rng.choice(plain) + rng.choice(plain)
        return " ".join(words)

    labels = np.arange(600) % 3 == 0
    model = toxicity.train([text(x) for x in labels], labels)
    fresh = np.arange(300) % 3 == 0
    scores = toxicity.score_texts(model, [text(x) for x in fresh])
    assert ((scores >= 0.5) == fresh).mean() > 0.95
    assert toxicity.score_texts(model, ["", None, "?!"]).tolist() == [0, 0, 0]
    assert toxicity.train(["a", "b"], np.array([True, True])) is None
    assert toxicity.score_texts(None, ["a"]).tolist() == [0]


def test_every_word_is_in_a_window():
    words = toxicity.Words([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 32, 33, 100)])
    windows, text = words.windows()
    for k, n in enumerate((0, 1, 32, 33, 100)):
        assert len(set(windows[text == k].ravel()) - {-1}) == n


def morse(n):
    """The Thue-Morse string of n letters and its complement, as two words."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_hash_follows_its_polynomials_and_parts_what_meets_modulo_a_power_of_two():
    rng = np.random.default_rng(1)
    buffer = rng.integers(0, 256, 3000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 2500, 100))
    stops = starts + rng.integers(1, 400, 100)
    lists = ([int(x) % PRIME for x in LETTERS], [int(x) >> 33 for x in LETTERS])

    def hashed(span):
        both = 0
        for base, letters in zip(PRIME_BASES, lists, strict=True):
            value = sum(letters[c] * pow(base, i, PRIME) for i, c in enumerate(span))
            both = both << 31 | value % PRIME
        return np.uint64(both) ^ mix(np.array([len(span)], np.uint64) * GOLDEN)

    want = [mix(hashed(buffer[a:b].tolist()))[0] for a, b in zip(starts, stops, strict=True)]
    assert spans_hashed(buffer, starts, stops).tolist() == want
    for n in (1024, 2048, 4096):
        hashes, _ = word_hashes([*morse(n), morse(n)[0]])
        assert hashes[0] != hashes[1] and hashes[0] == hashes[2]
