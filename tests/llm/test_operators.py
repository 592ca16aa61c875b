"""The operators and queries on small tables, against brute force and SQL."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import differences
from tradeflow.llm import common
from tradeflow.llm import queries as q
from tradeflow.llm.bpe import decode_ids, encode_texts
from tradeflow.llm.common import components
from tradeflow.llm.exact import drop_exact_copies, mark_exact_copies
from tradeflow.llm.lines import drop_repeated_lines
from tradeflow.llm.mixing import in_mixed_order, mix_sources
from tradeflow.llm.passages import drop_repeats, mark_repeats
from tradeflow.llm.setsketch import link_near_copies
from tradeflow.llm.sharding import number_slots, shard_records
from tradeflow.llm.token_counts import count_tokens
from tradeflow.llm.toxicity import fit, held_out, toxicity_score
from tradeflow.llm.vectors import link_vectors, smallest_labels

SF = "/root/testdata/sf0.01"
# Result names, helper names and others that an operator might use inside.
CLASHING = [
    "kept", "keep_id", "hash", "digest", "n", "node", "piece", "key", "bucket", "shard", "slot",
    "component", "component_id", "doc", "source", "rank", "block", "rep", "links", "vector",
    "mix_block", "start", "starts", "spans", "size", "n_links", "n_lines", "repeats",
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas()


def odd_docs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.withColumns({c: F.lit("own") for c in CLASHING})


ODD = [
    (None, "a b c d e f"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "a b c d e f"),
    (5, "A b  c d e f"), (5, "A b  c d e f"), (6, "word " * 30_000), (7, "x\ny\nx\ny\n\nx"),
    (8, "x\ny"), (9, "\x00 ퟿ é"),
]

OPERATORS = {
    "mix": mix_sources,
    "order": in_mixed_order,
    "exact": mark_exact_copies,
    "lines": drop_repeated_lines,
    "near": link_near_copies,
    "passages": mark_repeats,
    "cut": drop_repeats,
    "shard": lambda d: shard_records(d, "doc_id", [1.0, 2.0, 0.5], new_weight=1.0),
    "tokens": lambda d: d.withColumn("t", encode_texts(d, F.col("text"), q.WORD_FILE)),
    "count": lambda d: d.withColumn("t", count_tokens(d, F.col("text"), q.BYTE_FILE)),
    "toxic": lambda d: d.withColumn(
        "t",
        toxicity_score(d, F.col("text"), fit(d, d.select("doc_id", F.lit(1).alias("toxic")))),
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_names(spark, name):
    docs = odd_docs(spark, ODD)
    result = OPERATORS[name](docs)
    assert len({c.lower() for c in result.columns}) == len(result.columns)
    rows = result.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in ODD)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](odd_docs(spark, [])).collect() == []


def test_every_operator_is_registered():
    names = entry.queries()
    assert [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names and "op9_exact" in entry.oracle_sql()


def test_exact_equals_sql(spark):
    ours, theirs, extra, missing = differences(q.op9_exact(spark, SF), q.ORACLE["op9_exact"], SF)
    assert ours == theirs and not extra and not missing


@pytest.mark.parametrize("bits", [0, 1])
def test_exact_compares_bytes_where_hashes_collide(spark, bits):
    docs = spark.createDataFrame(
        [(1, "a b"), (2, "a  b"), (3, "c"), (4, "ab"), (5, None), (6, " "), (7, "d")],
        "doc_id long, text string",
    )
    weak = mark_exact_copies(docs, hashed=lambda t: F.length(t) % (bits + 1))
    rows = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in weak.collect()}
    assert rows == {
        1: (2, 3, False), 2: (2, 3, True), 3: (3, 1, True), 4: (2, 3, False),
        5: (6, 2, False), 6: (6, 2, True), 7: (7, 1, True),
    }
    assert {r["doc_id"] for r in drop_exact_copies(docs).collect()} == {2, 3, 6, 7}


def test_shards_are_whole_gapless_and_move_little(spark, documents):
    rows = q.op2_shard(spark, SF).toPandas()
    assert len(rows) == len(documents)
    text = dict(documents.itertuples(index=False))
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in rows.itertuples())
    for _, shard in rows.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    moved = rows[rows["shard"] != rows["grown_shard"]]
    assert set(moved["grown_shard"]) == {40} and len(moved) < 0.08 * len(rows)


def test_shard_weights_and_repeated_rows(spark):
    df = spark.range(6000).withColumnRenamed("id", "key")
    counts = shard_records(df, "key", [1.0, 2.0, 3.0]).groupBy("shard").count().collect()
    share = {r["shard"]: r["count"] / 6000 for r in counts}
    assert all(abs(share[s] - (s + 1) / 6) < 0.03 for s in range(3))
    same = spark.range(500).select(F.lit(1).alias("key"))
    slots = number_slots(shard_records(same, "key", [1.0, 1.0]), ["key"], pieces=4).collect()
    assert sorted(r["slot"] for r in slots) == list(range(500))
    with pytest.raises(ValueError):
        shard_records(df, "key", [1.0, 0.0])


def test_mix_keeps_targets_within_a_block(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 2000, "big").when(F.col("id") < 3000, "mid").otherwise("low")
        .alias("source"),
    )
    weights = {"big": 5.0, "mid": 3.0, "low": 2.0}
    mixed = mix_sources(docs, weights, block_rows=10, pieces=8).toPandas()
    mixed = mixed.sort_values("mix_position")
    assert len(mixed) == mixed["mix_position"].nunique() == 4000
    assert ((mixed.mix_release <= mixed.mix_slot) & (mixed.mix_slot < mixed.mix_deadline)).all()
    order = mixed.drop_duplicates("mix_slot")["source"].to_numpy()
    for name, w in weights.items():
        ahead = np.cumsum(order[:300] == name) - w / 10 * np.arange(1, 301)
        assert np.abs(ahead).max() < 1
    # The smallest runs out last here: from then on it stands alone.
    assert set(order[:340]) == set(weights) and len(order) == 400


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 9), (20, 21), (7, 7), (21, None), (30, 31), (31, 32), (32, 30)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r["node"], r["component"]) for r in found} == {
        (3, 3), (4, 3), (5, 3), (9, 3), (20, 20), (21, 20), (30, 30), (31, 30), (32, 30),
    }


def shingle_words(text, k):
    w = (text or "").encode().lower().split()
    k = min(k, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def test_near_copies_equal_brute_force(spark, documents):
    rows = q.op5_minhash(spark, SF).toPandas().set_index("doc_id")
    ids = sorted(documents["doc_id"])
    text = dict(documents.itertuples(index=False))
    sets = [shingle_words(text[i], 4) for i in ids]
    found = {}
    a, b = [], []
    for i, s in enumerate(sets):
        met = Counter(j for x in s for j in found.get(x, ()))
        for j, n in met.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a.append(j)
                b.append(i)
        for x in s:
            found.setdefault(x, []).append(i)
    label = smallest_labels(len(ids), np.array(a), np.array(b))
    assert [rows.component_id[i] for i in ids] == [ids[k] for k in label]
    assert [rows.n_shingles[i] for i in ids] == [len(s) for s in sets]
    assert all(rows.kept[i] == (rows.component_id[i] == i) for i in ids)


def test_near_copies_in_blocks_join_what_no_hub_joins(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):  # a chain: each differs from the one before in one word
        base[int(rng.integers(0, 200))] = f"n{i}"
        rows.append((i, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [shingle_words(t, 5) for _, t in rows]
    pairs = [
        (i, j) for i in range(60) for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    label = smallest_labels(60, *np.array(pairs).T)
    found = link_near_copies(docs, block=7).orderBy("doc_id").collect()
    assert [r["component_id"] for r in found] == label.tolist()


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(60, 32))
    x = [b + rng.normal(size=32) * s for b in base for s in (0, 0.1, 0.3, 0.35, 0.5)]
    x += [x[0]] * 20 + [x[0] * 3]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 32), (902, [float("nan")] * 32), (903, [None] * 32),
             (904, []), (None, rows[0][1]), (905, [float("inf")] + [1.0] * 31), (906, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = link_vectors(df, block=16).toPandas()
    assert len(found) == len(rows)
    u = np.array([np.float32(v).astype(float) for v in x])
    u /= np.linalg.norm(u, axis=1)[:, None]
    close = u @ u.T >= 0.9
    label = smallest_labels(len(u), *np.nonzero(close))
    good = found[found.vec_id < 900].sort_values("vec_id")
    assert good.n_links.tolist() == (close.sum(1) - 1).tolist()
    assert good.component_id.tolist() == label.tolist()
    rest = found[~(found.vec_id < 900)]
    assert rest.n_links.sum() == 0 and rest.kept.all()
    assert link_vectors(df.limit(0)).collect() == []


def test_lines_equal_brute_force(spark, documents):
    rows = {r["doc_id"]: r["text"] for r in q.op3_lines(spark, SF).collect()}
    seen = set()
    for doc, text in sorted(documents.itertuples(index=False)):
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip()]
        gone = set()
        for a, b in zip(full, full[1:], strict=False):
            key = (lines[a].strip(), lines[b].strip())
            gone |= {a, b} if key in seen else set()
            seen.add(key)
        assert rows[doc] == "\n".join(x for i, x in enumerate(lines) if i not in gone)


@pytest.mark.parametrize("n", [1024, 4096])
def test_texts_that_meet_modulo_a_power_of_two_are_different(spark, n):
    bits = [bin(i).count("1") % 2 for i in range(n)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert [r["component_id"] for r in link_near_copies(docs).orderBy("doc_id").collect()] == [1, 2]
    rows = [(1, f"{a}\nsecond line"), (2, f"{b}\nsecond line"), (3, f"{a}\nsecond line")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in drop_repeated_lines(docs).collect()}
    assert kept[1] == rows[0][1] and kept[2] == rows[1][1] and kept[3] != rows[2][1]
    rest = " ".join(f"w{i}" for i in range(60))
    rows = [(1, " ".join([a, *[f"x{i}" for i in range(49)]])),
            (2, " ".join([b, *[f"x{i}" for i in range(49)]])), (3, rest)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = mark_repeats(docs).collect()
    assert all(r["n_repeated_words"] < 50 for r in found)


def test_planted_passages_are_found_and_clean_texts_left(spark):
    rng = np.random.default_rng(6)

    def some(n):
        return [f"w{k}" for k in rng.integers(0, 500, n)]

    passage = some(60)
    edited = [*passage[:30], "changed", *passage[31:]]
    rows = [(i, " ".join(some(200))) for i in range(30)]
    rows += [(100 + i, " ".join(some(40) + passage + some(90))) for i in range(8)]
    rows += [(200, " ".join(some(10) + edited * 1 + some(30))), (201, " ".join(passage[:40]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in mark_repeats(docs).collect()}
    assert {i for i, r in found.items() if r["repeats"]} == {*range(101, 108), 200}
    for i in range(101, 108):
        span = found[i]["repeats"][0]
        assert (span["start"], span["stop"], span["source"]) == (40, 100, 100)
    cut = {r["doc_id"]: r["text"] for r in drop_repeats(docs).collect()}
    texts = dict(rows)
    assert all(cut[i] == texts[i] for i in cut if not found[i]["repeats"])
    assert len(cut[101].split()) == 130


def test_passages_within_a_document_and_rows_of_one_id(spark):
    rng = np.random.default_rng(7)
    passage = [f"w{k}" for k in rng.integers(0, 900, 80)]
    other = [f"v{k}" for k in rng.integers(0, 900, 300)]
    rows = [(1, " ".join(passage * 6)), (2, " ".join(other)), (3, " ".join([*other[100:200], "x"]))]
    docs = spark.createDataFrame([*rows, rows[2], (3, "y")], "doc_id long, text string")
    found = mark_repeats(docs).select("doc_id", "n_repeated_words", "repeats").collect()
    words = {}
    for r in found:
        words.setdefault(r["doc_id"], []).append(r["n_repeated_words"])
    assert words == {1: [400], 2: [0], 3: [100, 100, 100]}
    for s in next(r["repeats"] for r in found if r["doc_id"] == 1):
        assert s["source_stop"] <= s["start"]


def test_exact_passages_of_the_corpus_are_found(spark, documents):
    rows = q.op8_passages(spark, SF).filter("n_repeated_words > 0").collect()
    first, elsewhere = {}, set()
    for doc, text in sorted(documents.itertuples(index=False)):
        w = text.encode().lower().split()
        for k in range(len(w) - 49):
            at = first.setdefault(tuple(w[k : k + 50]), (doc, k))
            if at[0] != doc:
                elsewhere.add(doc)
    assert elsewhere - {r["doc_id"] for r in rows} == set()
    # All that is found is a near copy: nothing else is marked.
    text = dict(documents.itertuples(index=False))
    for r in rows:
        for s in r["repeats"]:
            late = text[r["doc_id"]].encode().split()[s["start"] : s["stop"]]
            early = text[s["source"]].encode().split()[s["source_start"] : s["source_stop"]]
            x, y = (shingle_words(b" ".join(w).decode(), 5) for w in (late, early))
            assert min(len(late), len(early)) >= 50
            assert len(x & y) >= 0.8 * len(x | y)


def test_passages_of_which_every_part_stands_earlier_elsewhere(spark):
    rng = np.random.default_rng(12)
    fresh_words = iter(range(10**6))

    def some(n):
        return [f"c{next(fresh_words)}" for _ in range(n)]

    rows = []
    for k in range(12):
        passage = [f"p{k}x{i}" for i in range(50 + 5 * k)]
        for _ in range(12):  # all its shingles, in parts of 30 words with other neighbours
            for i in range(0, len(passage) - 4, 13):
                rows.append(some(60) + passage[i : i + 30] + some(60))
        rows.append(some(20) + passage + some(int(rng.integers(0, 60))))
        rows.append(some(30) + passage + passage[3:8] + some(70))
    # A copy whose two halves have different sources, and one within a document.
    rows.append(rows[-1][20:110] + rows[-3][0:70])
    rows.append(some(9) + rows[-2][25:90] + some(20) + rows[-2][25:90] + some(5))
    docs = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string"
    )
    found = {r["doc_id"]: r["repeats"] for r in mark_repeats(docs).collect()}
    seen = {}
    for doc, w in enumerate(rows):
        due = set()
        for k in range(len(w) - 49):
            at = seen.setdefault(tuple(w[k : k + 50]), (doc, k))
            if at[0] != doc or at[1] + 50 <= k:
                due |= set(range(k, k + 50))
        covered = {i for s in found[doc] for i in range(s["start"], s["stop"])}
        assert due <= covered, doc
        assert bool(due) == bool(covered), doc


def test_tokens_round_trip(spark, documents):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    rows = docs.select("text", encode_texts(docs, F.col("text"), q.WORD_FILE).alias("t"))
    rows = rows.select("t.*", decode_ids(docs, F.col("t.ids"), q.WORD_FILE).alias("back"))
    for r in rows.collect():
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["back"].encode()).hexdigest()


def test_toxicity_query(spark):
    rows = q.op6_toxicity(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert rows["score"].between(0, 1).all()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows.itertuples())
    both = rows[rows.held_out].merge(labels, on="doc_id")
    assert ((both.score >= 0.5) == (both.toxic == 1)).mean() > 0.9


def test_pipeline_equals_its_stages_by_brute_force(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    clean = stages["toxicity"](spark, table, SF)
    assert clean.columns == table.columns
    ids = {r[0] for r in clean.select("doc_id").collect()}
    text = dict(documents.itertuples(index=False))
    best = {}
    for i in sorted(ids):
        key = "".join(text[i].split(" ")).translate({c: None for c in range(9, 14)})
        if key not in best or len(text[i]) > len(text[best[key]]):
            best[key] = i
    singles = sorted(best.values())
    sets = {i: shingle_words(text[i], 5) for i in singles}
    found, links = {}, []
    for i in singles:
        met = Counter(j for x in sets[i] for j in found.get(x, ()))
        links += [
            (j, i) for j, n in met.items()
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n)
        ]
        for x in sets[i]:
            found.setdefault(x, []).append(i)
    at = {i: k for k, i in enumerate(singles)}
    ends = np.array([(at[a], at[b]) for a, b in links]).reshape(-1, 2)
    label = smallest_labels(len(singles), ends[:, 0], ends[:, 1])
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == [i for k, i in enumerate(singles) if label[k] == k]
    for r in rows:
        assert r["n_tokens"] == len(r["token_ids"])


def test_pipeline_rows_stand_in_the_order_of_the_mix(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[3:])
    rows = corpus_pipeline.run(spark, SF).select("doc_id", "mix_slot", "mix_position").collect()
    due = mix_sources(spark.read.parquet(f"{SF}/documents.parquet")).orderBy("mix_position")
    assert rows == due.select("doc_id", "mix_slot", "mix_position").collect()


def test_stages_on_odd_rows_and_clashing_names(spark):
    """Nulls, repeated rows, empty and long texts; every column comes back as it was."""
    names = [*CLASHING, "toxicity_score", "mix_slot", "mix_position", "text_sha256", "n_shingles"]
    names = sorted({n.lower() for n in names} - {"source"})
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumns(
        {**{c: F.lit("own") for c in names}, "source": F.lit(None).cast("string"), "lang": F.lit("x")}
    )
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert labels.count()
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        assert len({c.lower() for c in result.columns}) == len(result.columns)
        rows = result.collect()
        assert len(rows) <= len(ODD) and len(rows) > 0
        if name != "encoding":
            assert result.columns[: len(docs.columns)] == docs.columns
            assert all(r[c] == "own" for r in rows for c in names)
        if name in ("mixing", "encoding"):
            assert len(rows) == len(ODD)
        empty = stage(spark, docs.limit(0), SF)
        assert empty.collect() == [] and empty.columns == result.columns
    # Along the chain the place is the mix's, not the documents' own.
    mixed = dict(corpus_pipeline.STAGES)["mixing"](spark, docs, SF)
    last = dict(corpus_pipeline.STAGES)["encoding"](spark, mixed, SF).collect()
    assert sorted(r["mix_position"] for r in last) == sorted(r["_mix_position"] for r in mixed.collect())


def test_pipeline_leaves_its_last_table_only(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("exact_dedup", corpus_pipeline.without_exact_copies),
                                                    *corpus_pipeline.STAGES[3:]])
    monkeypatch.setattr(common, "scratch_folder", lambda *_: str(tmp_path / "run"))
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    names = [p.name for p in (tmp_path / "run").iterdir()]
    assert [n for n in names if not n.startswith(".")] == ["encoding"]


def test_held_out_is_the_remainder(spark):
    rows = spark.range(50).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)
