"""Ranked BPE, draws for a target and vector codes, against the library and brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from compare import differences
from tradeflow.llm import importance
from tradeflow.llm import queries as q
from tradeflow.llm import ranked_bpe
from tradeflow.llm.codes import Grid, compress_vectors, whole_numbers, with_group_sum
from tradeflow.llm.importance import draw_for_target, rank_for_target
from tradeflow.llm.ranked_bpe import RankedCodec, RankedMerges, decode_ranked, encode_ranked

SF = "/root/testdata/sf0.01"
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(q.RANK_FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return RankedCodec(q.RANK_FILE, PATTERN)


def odd_texts():
    rng = random.Random(3)
    parts = list("  \n\t'sx.e1ÀéßΣσİǺ漢　\x1c\x85👍​ᲊ՘\U0001e5d0Ƛࢗ") + [
        "<|endoftext|>", "<|startoftext|>", "the", "ing", " ", "!!", "ΑΣ", "'ll",
    ]
    yield from ("".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(2000))
    for letters, longest, n in (("etaoinshrdl", 25, 1500), ("ab", 300, 40), ("漢字日本語の人大中", 300, 40)):
        yield from ("".join(rng.choices(letters, k=rng.randint(1, longest))) for _ in range(n))
    yield from ["", "a" * 50_000, "!?" * 3000, "ab " * 1000, " " * 3000, "x" + " " * 500 + "y"]
    yield from ["=" * 5001, "ha" * 3000, "aab" * 3000, "\n" * 3000, "0" * 4000]


def test_ranked_codec_equals_the_library(codec, library):
    texts = list(odd_texts())
    for text, (n, ids, decoded) in zip(texts, codec.encode(pa.array(texts)), strict=True):
        want = library.encode_ordinary(text)
        assert (n, bytes(ids).decode()) == (len(want), ",".join(map(str, want)))
        assert decoded == text.encode()
    assert list(codec.encode(pa.array([None], pa.string()))) == [(0, b"", b"")]
    assert list(codec.encode(pa.array([], pa.string()))) == []


def test_bounded_steps_and_small_memories_change_nothing(library, monkeypatch):
    monkeypatch.setattr(ranked_bpe, "STEPS_OF_ROWS", 500)
    monkeypatch.setattr(ranked_bpe, "ROWS", 300)
    monkeypatch.setattr(ranked_bpe, "REMEMBERED", 20)
    texts = list(odd_texts())[1500:2300]
    codec = RankedCodec(q.RANK_FILE, PATTERN)
    found = [x for k in range(0, 800, 50) for x in codec.encode(pa.array(texts[k : k + 50]))]
    ids = [list(map(int, bytes(i).split(b","))) if n else [] for n, i, _ in found]
    assert ids == [library.encode_ordinary(t) for t in texts]


def test_long_words_take_the_pairs_in_the_order_of_one_by_one():
    """Every step of a long word against contracting one pair at a time."""
    merges, rng = RankedMerges(q.RANK_FILE), random.Random(5)
    words = ["".join(rng.choices("abthein ", k=rng.randint(2, 60))).encode() for _ in range(300)]
    letters = [merges.single[np.frombuffer(w, np.uint8)] for w in words]
    runs = list(merges._encode_words(ranked_bpe.RUNS, letters))
    assert runs == list(merges._encode_words(ranked_bpe.LEFTMOST, letters))


def test_ids_round_trip(spark, library):
    rows = [(1, "The cat’s ＡＢＣ 12"), (2, None), (3, ""), (4, "word " * 20_000), (4, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("own"))
    found = docs.select("*", encode_ranked(docs, F.col("text"), q.RANK_FILE, PATTERN).alias("t"))
    found = found.withColumn("back", decode_ranked(docs, F.col("t.ids"), q.RANK_FILE, PATTERN))
    for r in found.collect():
        want = library.encode_ordinary(r["text"] or "")
        assert r["t"]["ids"] == want and r["t"]["n_tokens"] == len(want) and r["ids"] == "own"
        assert r["t"]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r["back"] == (r["text"] or "").encode()
        assert r["t"]["decoded_sha256"] == hashlib.sha256(r["back"]).hexdigest()
    odd = spark.createDataFrame([(1, [5, 60_000]), (2, None), (3, [])], "i int, ids array<int>")
    back = odd.select("i", decode_ranked(odd, F.col("ids"), q.RANK_FILE, PATTERN).alias("b"))
    assert dict(back.collect()) == {1: None, 2: None, 3: b""}


def test_ranked_query_equals_the_library(spark, library):
    rows = {r["doc_id"]: r for r in q.op11_ranked_bpe(spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc, text in texts:
        ids = library.encode_ordinary(text or "")
        assert rows[doc]["n_tokens"] == len(ids)
        assert rows[doc]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[doc]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_importance_equals_sql(spark):
    ours, theirs, extra, missing = differences(
        q.op12_importance(spark, SF), q.ORACLE["op12_importance"], SF
    )
    assert ours == theirs and not extra and not missing


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ranks_by_brute_force(docs, target, longest, percent, least):
    def words(text):
        return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    def features(text):
        w = words(text)
        runs = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        return [zlib.crc32(r.encode()) % 100 for r in runs]

    s, t = (Counter(k for x in texts for k in features(x)) for texts in ([d for _, d in docs], target))
    a, b = sum(s.values()) + 100, sum(t.values()) + 100
    gain = [math.floor(1000 * math.log((t[k] + 1) * a / ((s[k] + 1) * b))) for k in range(100)]
    rows = []
    for doc, text in docs:
        f = features(text)
        weight = sum(gain[k] for k in f) // len(f) if f else 0
        key = "" if doc is None else doc
        h = int(hashlib.sha256(f"2024:{key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((doc, len(f), weight, score, len(words(text)) >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(order) // 100
    return rows, [(r[3], r[0]) for r in order[:drawn]]


@pytest.mark.parametrize("longest", [1, 3])
def test_draw_with_ties_repeats_and_odd_rows(spark, monkeypatch, longest):
    monkeypatch.setattr(importance, "SEGMENT_ROWS", 40)  # many segments
    monkeypatch.setattr(importance, "SAMPLES_PER_SEGMENT", 4)
    rng = random.Random(9)
    words = ["alpha", "BETA", "gamma", "é", "1x", "zeta"]
    docs = [(i % 200, " ".join(rng.choices(words, k=rng.randint(0, 9)))) for i in range(300)]
    docs += [(7, "alpha beta gamma")] * 400 + [(None, "alpha 1x"), (None, "alpha 1x"), (900, None)]
    docs += [(901, ""), (902, "?? ,,"), (903, "word " * 30_000), (904, "\x00a\x00b é")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    frame = frame.withColumns({c: F.lit("own") for c in ("score", "rank", "segment", "words")})
    target = spark.createDataFrame([("alpha gamma gamma é",), (None,)], "text string")
    options = {"longest_run": longest, "buckets": 100, "min_words": 2, "percent": 60}
    found = rank_for_target(frame, target, **options)
    assert len(set(found.columns)) == len(found.columns)
    rows, drawn = ranks_by_brute_force(docs, ["alpha gamma gamma é", None], longest, 60, 2)
    result = found.select("doc_id", "n_features", "weight", "_score", "_rank", "score").collect()
    assert Counter(tuple(r)[:4] for r in result) == Counter(r[:4] for r in rows)
    assert {r["score"] for r in result} == {"own"}
    ranked = sorted((r for r in result if r["_rank"] is not None), key=lambda r: r["_rank"])
    assert [r["_rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["_score"], r["doc_id"]) for r in ranked] == drawn
    best = draw_for_target(frame, target, **options)
    assert best.columns == frame.columns
    assert [r["doc_id"] for r in best.collect()] == [i for _, i in drawn]


def test_draw_from_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    assert rank_for_target(empty, empty).collect() == []
    weight = math.floor(1000 * math.log(10_030 / (31 * 10_000)))
    assert [tuple(r)[2:4] for r in rank_for_target(some, empty).collect()] == [(30, weight)]


def codes_by_brute_force(rows, parts, entries, rounds):
    """(codebooks, [(code, error)]) of rows of (id, vector of integers)."""
    width = len(rows[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for _, v in rows] for p in range(parts)]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    books = [[list(cut[p][i]) for i in first[:entries]] for p in range(parts)]

    def nearest(point, book):
        d = [sum((a - b) ** 2 for a, b in zip(point, e)) for e in book]  # noqa: B905
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for point in cut[p]:
                members.setdefault(nearest(point, books[p])[0], []).append(point)
            for k, held in members.items():
                books[p][k] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    found = [[nearest(cut[p][i], books[p]) for p in range(parts)] for i in range(len(rows))]
    return books, [("".join(f"{k:02x}" for k, _ in f), sum(d for _, d in f)) for f in found]


def digest(books):
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


@pytest.mark.parametrize("large", [False, True])
def test_codes_equal_brute_force(spark, large):
    rng = np.random.default_rng(2)
    vectors = [list(map(float, np.float32(v))) for v in rng.normal(size=(90, 8))]
    vectors += [vectors[3]] * 60 + [[0.0] * 8]
    if large:
        vectors += [[float(np.float32(3e38))] + [0.5] * 7, [-float(np.float32(1e30))] * 8]
    rows = [(200 - i, v) for i, v in enumerate(vectors)] + [(None, vectors[0]), (200, vectors[1])]
    odd = [(1000, None), (1001, [float("nan")] * 8), (1002, [float("inf")] + [0.0] * 7),
           (1003, [None] * 8), (1004, vectors[0]), (-1, [None, 1.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(3)
    frame = frame.withColumns({c: F.lit("own") for c in ("code", "numbers", "entry")})
    kept = [*rows, odd[4]]
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in kept]
    books, want = codes_by_brute_force(whole, 2, 7, 3)
    found = compress_vectors(frame, parts=2, entries=7, rounds=3)
    got = found.select("vec_id", "embedding", "_code", "error", "codebooks_sha256", "code").collect()
    assert {r["codebooks_sha256"] for r in got} == {digest(books)}
    assert {r["code"] for r in got} == {"own"}
    expected = Counter(
        (i, tuple(v), c, e if e < 2**63 else None) for (i, v), (c, e) in zip(kept, want, strict=True)
    )
    assert Counter((r[0], tuple(r[1]), r[2], r[3]) for r in got) == expected


def test_codes_of_odd_lengths_and_nothing(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, []), (3, [0.5]), (4, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(1, [1024, 2048, 3072, 0]), (2, [0] * 4), (3, [512, 0, 0, 0])]
    books, want = codes_by_brute_force(whole, 2, 2, 4)
    got = compress_vectors(frame, parts=2, entries=2).orderBy("vec_id").collect()
    assert [(r["code"], r["error"]) for r in got] == want
    assert {r["codebooks_sha256"] for r in got} == {digest(books)}
    assert compress_vectors(frame.limit(0)).collect() == []
    assert compress_vectors(frame.filter("vec_id = 4")).collect() == []


@pytest.mark.parametrize("side", [1, 40, 3000])
def test_grid_keeps_the_nearest_and_ties(side):
    rng = np.random.default_rng(side)
    points = rng.integers(-side, side, (3000, 4))
    grid = Grid(points[:50].copy())
    d = ((points[:, None] - points[None, :50]) ** 2).sum(2)
    for _ in range(2):  # the second time from memory
        index, squared = grid.nearest(points)
        assert (index == d.argmin(1)).all() and (squared == d.min(1)).all()


def test_whole_numbers_are_exact():
    values = [1e300, -1e300, 3.0e38, -0.0001, 1.7976931348623157e308]
    want = [int(values[0]) * 1024, int(values[1]) * 1024, int(3.0e38) * 1024, -1, int(values[4]) * 1024]
    assert whole_numbers(np.array(values)).tolist() == want


def test_group_sums_with_null_keys(spark):
    rows = [(1, 5), (1, None), (None, 2), (None, 3), (2, None), (3, 2**63 - 1), (3, 1)]
    frame = spark.createDataFrame(rows, "label int, total long")
    found = with_group_sum(frame, "label", "total", "sum").collect()
    assert Counter(map(tuple, found)) == Counter(
        (a, b, {1: 5, None: 5, 2: None, 3: None}[a]) for a, b in rows
    )


def test_codes_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    numbers = np.floor(1024 * np.array([r["embedding"] for r in table], float)).astype(np.int64)
    codes, errors, books = [], 0, []
    for p in range(4):
        points = numbers[:, 16 * p : 16 * p + 16]
        book = points[:256].copy()
        for last in (False,) * 4 + (True,):
            d = np.stack([((points - e) ** 2).sum(1) for e in book], 1)
            index = d.argmin(1)
            for k in () if last else np.unique(index):
                book[k] = points[index == k].sum(0) // (index == k).sum()
        codes.append(index)
        errors = errors + d.min(1)
        books.append(book.tolist())
    by_label = Counter()
    for r, e in zip(table, errors.tolist(), strict=True):
        by_label[r["label"]] += e
    got = {r["vec_id"]: r for r in q.op13_codes(spark, SF).collect()}
    for i, r in enumerate(table):
        row = got[r["vec_id"]]
        assert row["code"] == "".join(f"{c[i]:02x}" for c in codes)
        assert (row["error"], row["label_error"]) == (errors[i], by_label[r["label"]])
        assert row["codebooks_sha256"] == digest(books)
    assert len(got) == len(table)
