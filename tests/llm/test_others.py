"""Classifier, vectors, chats, pipeline."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm.chat import CHATML, escape, format_chats, loss_text, read_turns, unescape
from lectern.llm.importance import classify, resampled, top_k, wanted_rows
from lectern.llm.srs import candidates, chi_square_quantile, nearest_products, search
from lectern.llm.vafile import top_products

SF = "/root/testdata/sf0.001"


def test_classifier_on_held_out_labels(spark):
    rng = random.Random(0)
    good, bad = [f"good{i}" for i in range(300)], [f"junk{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(bad if i % 4 == 0 else good) for _ in range(rng.randrange(20, 200)))) for i in range(400)]
    docs = spark.createDataFrame([*rows, (400, None), (401, ""), (None, rows[1][1]), rows[1]], "doc_id long, text string").withColumn("n_grams_", F.lit(1))
    labels = spark.createDataFrame([(i, int(i % 4 != 0), None) for i in range(200)] + [(5, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = classify(docs, labels, k=304, buckets=2000).collect()
    assert len(got) == 404
    held = [(r.keep, r.doc_id % 4 != 0) for r in got if r.doc_id is not None and 200 <= r.doc_id < 400]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(r.keep for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4)
    again = {r.doc_id: r.gumbel_key for r in classify(docs.repartition(7), labels, buckets=2000).collect()}
    assert all(abs(again[r.doc_id] - r.gumbel_key) < 1e-9 for r in got)


def test_resampling_by_brute_force(spark):
    """Counts, ratios, weights, noise and the sample, all from their definitions."""
    from lectern.llm.common import mix, span_hashes

    def hashed(word):
        raw = np.frombuffer(word.encode(), np.uint8)
        return int(span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])

    def buckets_of(text):
        h = [hashed("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        pairs = [int(mix(np.array([(a * 0x9FB21C651E98DF25 + b) % 2**64], np.uint64))[0]) for a, b in zip(h, h[1:], strict=False)]
        return [x % 50 for x in [*h, *pairs]]

    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["aB", "b", "C", "dé", "é", "x" * 90]) for _ in range(rng.randrange(30)))) for i in range(60)] + [(60, None), (61, "  "), (None, "a b"), (7, "b b")]
    marks = [(i, int(i % 3 > 0)) for i in range(40)]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in rows], "doc_id long, text string, keep int, n_grams int, others int, id int, body int")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    turn = {r.doc_id: r.t for r in labels.select("doc_id", F.xxhash64(F.lit(3), "doc_id").alias("t")).collect()}
    noise = {r.doc_id: -math.log(-math.log((((r.t % 2**64) >> 11) + 0.5) / 2**53)) for r in docs.select("doc_id", F.xxhash64(F.lit(3), "doc_id").alias("t")).collect()}
    model = {i for i, q in marks if q and turn[i] % 5}
    raw, target = np.zeros(50), np.zeros(50)
    for i, t in rows:
        for b in buckets_of(t):
            raw[b] += 1
            target[b] += i in model
    ratio = np.log((target + 1) / (target.sum() + 50)) - np.log((raw + 1) / (raw.sum() + 50))
    expected = [(i, len(buckets_of(t)), sum(ratio[b] for b in buckets_of(t)) + noise[i]) for i, t in rows]
    share = [q for i, q in marks if turn[i] % 5 == 0]
    p = sum(share) / len(share)
    assert 0 < p < 1
    for k in (None, 0, 1, 10, 63, 64, 100):
        edge = math.ceil(64 * (p + math.sqrt(p * (1 - p) / len(share)))) if k is None else k
        best = sorted(sorted(expected, key=lambda r: (r[0] is not None, r[0] or 0)), key=lambda r: -round(r[2], 6))[:edge]
        got = resampled(docs, labels, k, buckets=50, seed=3).collect()
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        for r, (i, n, g) in zip(sorted(((r.doc_id, r.n_grams, r.gumbel_key) for r in got), key=key), sorted(expected, key=key), strict=True):
            assert r[:2] == (i, n)
            assert abs(r[2] - g) < 1e-9
        assert sorted((r.doc_id for r in got if r.keep), key=str) == sorted((i for i, _, _ in best), key=str)
    whole = classify(docs, labels, 10, buckets=50, seed=3)
    assert whole.columns == ["doc_id", "text", "others", "id", "body", "n_grams", "log_weight", "gumbel_key", "keep"]
    assert [r.others for r in whole.collect()] == [3] * 64
    assert sum(r.keep for r in whole.collect()) == 10


def test_wanted_rows(spark):
    labels = lambda good, bad: spark.createDataFrame([(True,)] * good + [(False,)] * bad, "_good boolean")
    assert wanted_rows(labels(80, 20), 1000) in (840, 841)
    assert wanted_rows(labels(5, 0), 10) == wanted_rows(labels(0, 5), 10) == wanted_rows(labels(0, 0), 10) == 10


def test_classifier_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.keep for r in classify(docs, none, buckets=100).collect()] == [True, True]
    assert classify(docs.limit(0), none, buckets=100).count() == 0


@pytest.mark.parametrize("k", [0, 1, 7, 50, 99, 100, 1000])
def test_top_k(spark, k):
    rng = random.Random(k)
    rows = [(i, float(rng.choice([1, 2, 2.5, -3e5, rng.random()]))) for i in range(100)]
    scored = spark.createDataFrame(rows, "doc_id long, gumbel_key double")
    got = {r.doc_id for r in scored.where(top_k(scored, k)).collect()}
    assert got == {i for i, _ in sorted(rows, key=lambda r: (-round(r[1], 6), r[0]))[:k]}


def vectors(n=900, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, dims))
    x = centres[rng.integers(0, 20, n)] + 0.3 * rng.standard_normal((n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    rows[100:400:2] = [(i, rows[0][1]) for i in range(100, 400, 2)]  # a hot vector
    rows += [(n, None), (n + 1, [float("nan")] * dims), (n + 20, [float("inf")] + [0.0] * (dims - 1)), (n + 3, [0.0] * dims), (n + 4, [1.0]), (None, rows[0][1]), (n + 5, [None] + [1.0] * (dims - 1))]
    return rows, dims


def test_top_products(spark):
    rows, dims = vectors()
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, block int, ids int")
    got = top_products(df, F.col("vec_id") % 50 == 0, 5, group_rows=100, block_rows=30, query_rows=7).collect()
    ints = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in rows if i is not None and v and len(v) == dims and None not in v and np.isfinite(v).all()}
    expected = []
    for q in ints:
        if q % 50 == 0:
            best = sorted(((-int(ints[q] @ v), i) for i, v in ints.items() if i != q))[:5]
            expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(expected)
    assert top_products(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert [tuple(r) for r in top_products(df.where("vec_id in (0, 3)"), F.col("vec_id") == 0).collect()] == [(0, 1, 3, int(ints[0] @ ints[3]))]


@pytest.mark.parametrize("cell_rows", [4096, 64])
def test_nearest_products(spark, cell_rows):
    rows, dims = vectors()
    df = spark.createDataFrame([(i, v, 1) for i, v in [*rows, rows[20]]], "vec_id long, embedding array<float>, cell int")
    got = nearest_products(df, F.col("vec_id") % 20 == 0, 10, cell_rows=cell_rows).toPandas()
    real = {i: np.array(v, float) for i, v in rows if i is not None and v and len(v) == dims and None not in v and np.isfinite(v).all() and np.any(v)}
    hit = total = 0
    for q in (i for i in real if i % 20 == 0):
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11))
        assert q not in set(own.vec_id)
        for v, s in zip(own.vec_id, own.score, strict=True):
            assert abs(s - float(real[v] @ real[q])) < 1e-9
        assert own.score.is_monotonic_decreasing
        kth = sorted((-float(real[q] @ v) for i, v in real.items() if i != q))[9]
        hit += int((own.score >= -kth - 1e-9).sum())
        total += 10
    assert hit / total >= 0.95
    assert nearest_products(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_search_in_a_leaf():
    """Without a stop all vectors are read; with one, those in the order of their projected distance up to it."""
    x = np.random.default_rng(2).standard_normal((1000, 5))
    x[300:400] = x[0]
    ids, n2 = np.arange(1000), (x * x).sum(1)
    for i in (0, 700):
        away = np.random.default_rng(3).random(1000)
        expected = sorted((-float((x[j] * x[i]).sum()), j) for j in range(1000) if j != i)[:7]
        found, scores, read = search(x, ids, away, x[i], i, n2[i] + n2.max(), np.inf, 7, -np.inf, 64)
        assert ([-s for s in scores.tolist()], found.tolist(), read) == ([s for s, _ in expected], [j for _, j in expected], 1000)
        kth = -expected[-1][0]
        stop = 0.3 / (n2[i] + n2.max() - 2 * kth)
        assert search(x, ids, away, x[i], i, n2[i] + n2.max(), stop, 7, kth, 64)[2] == (away <= 0.3).sum()


@pytest.mark.parametrize("kind", ["sphere", "clusters"])
def test_index_reads_few_vectors(spark, kind):
    """Over several cells recall is 0.9 or more with well under half of the vectors read, without any structure and with some."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((24_000, 64))
    if kind == "clusters":
        x = rng.standard_normal((60, 64))[rng.integers(0, 60, 24_000)] + 0.7 * x
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    found = candidates(df, F.col("vec_id") % 200 == 0, 20).cache()
    read = found.agg(F.sum("read")).first()[0]
    best = found.where("vec_id is not null").toPandas().sort_values("score", ascending=False).groupby("query_id").head(20)
    assert len(best) == 120 * 20
    x, hit = x.astype(float), 0
    for q, own in best.groupby("query_id"):
        score = x @ x[q]
        score[q] = -np.inf
        hit += int((own.score >= np.sort(score)[-20] - 1e-9).sum())
    assert hit / len(best) >= 0.9
    assert read < 120 * 24_000 * 0.45


def test_few_exact_reads(spark):
    """Lossy cells leave few vectors to be read, and results are exact."""
    rng = np.random.default_rng(12)
    x = rng.standard_normal((6000, 64))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    ints = np.floor(256 * x.astype(float)).astype(int)
    queries = range(0, 6000, 100)
    expected = [(q, r + 1, i, -s) for q in queries for r, (s, i) in enumerate(sorted((-int(p), i) for i, p in enumerate(ints @ ints[q]) if i != q)[:5])]
    for bits, most_left, most_read in ((4, 0.4, 0.06), (6, 0.02, 0.01)):
        report = {}
        got = top_products(df, F.col("vec_id") % 100 == 0, 5, bits=bits, group_rows=1000, block_rows=300, query_rows=16, report=report).collect()
        assert sorted(map(tuple, got)) == expected
        assert report["bounds"] == 60 * 6000
        assert report["left"] < most_left * report["bounds"], report
        assert report["exact"] < most_read * report["bounds"], report


def test_chi_square():
    assert abs(chi_square_quantile(0.95, 8) - 15.507) < 1e-3
    assert abs(chi_square_quantile(0.5, 2) - 1.3863) < 1e-3


def test_recall_on_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = nearest_products(df, F.col("vec_id") % 20 == 0, 20).toPandas()
    x = df.toPandas().set_index("vec_id").embedding
    m = np.stack(x.to_numpy()).astype(float)
    hit = 0
    for q in sorted(got.query_id.unique()):
        score = m @ m[x.index.get_loc(q)]
        score[x.index.get_loc(q)] = -np.inf
        hit += len(set(x.index[np.argsort(-score)[:20]]) & set(got[got.query_id == q].vec_id))
    assert hit / (20 * got.query_id.nunique()) >= 0.9


CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\nno &lt;| &amp; &"), (1, 2, "user", "é😀"), (1, 3, "assistant", ""),
    (2, 1, "assistant", "late"), (2, 0, "assistant", "first"), (3, 0, None, None), (3, None, "user", " x \n"), (4, 0, "sys\ntem<|im_start|>", "&#10;"), (4, 0, "sys\ntem<|im_start|>", "&#10;"),
    (None, 0, "user", "null conversation"), (5, 0, "system", "a" * 100_000), (5, 1, "user", "b"),
]


def test_chats(spark):
    df = spark.createDataFrame([(*c, 9, "z") for c in CHATS], "conv_id long, turn long, role string, text string, start int, body string")
    got = format_chats(df).withColumn("turns", read_turns(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("spans"))).collect()
    by = {}
    for c in CHATS:
        by.setdefault(c[0], []).append(c)
    assert {r.conv_id for r in got} == set(by)
    for r in got:
        own = sorted(by[r.conv_id], key=lambda c: (c[1] is not None, c[1], c[2] or "", c[3] or ""))
        assert [(t.role, t.text) for t in r.turns] == [(c[2] or "", c[3] or "") for c in own]
        assert r.loss == "".join(c[3] for c in own if c[2] == "assistant")
        for s, t in zip(r.spans, r.turns, strict=True):
            assert r.formatted[s.start : s.start + s.length].count("<|") == 0
            assert s.loss == (t.role == "assistant")
    valid = {r.conv_id: (r.valid, r.error_turn) for r in got}
    assert valid[1] == (True, None)
    assert valid[2] == (False, 0)
    assert valid[5] == (True, None)
    assert valid[4][0] is False
    assert format_chats(df.limit(0)).count() == 0


def test_escapes(spark):
    texts = ["<|", "&lt;|", "&amp;lt;|", "&<|&", "<<||", "", "&amp;", "<|im_start|>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e")).withColumn("u", unescape(F.col("e")))
    for r in df.collect():
        assert r.u == r.t
        assert "<|" not in r.e


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        after = spark.createDataFrame(after.toPandas(), docs.schema)
        assert after.columns == columns, name
        assert 0 < after.count() <= n
        docs, n = after, after.count()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in docs.collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen, copies = set(), set()
    for i in sorted(texts):
        digest = hashlib.sha256(texts[i].encode()).digest()
        copies |= {i} if digest in seen else set()
        seen.add(digest)
    assert not copies & kept
    clean = [i for i, r in labels.items() if r.quality == 1 and i not in copies]
    assert len([i for i in clean if i in kept]) >= 0.85 * len(clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == kept
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())


def test_pipeline_with_odd_rows(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b", None, None, None), (2, "a b", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, docs.limit(0)):
        at = start
        for _, stage in corpus_pipeline.STAGES:
            at = spark.createDataFrame(stage(spark, at, str(tmp_path)).collect(), stage(spark, at, str(tmp_path)).schema)
        assert (at.count() > 0) == (start is docs)


def test_pipeline_keeps_one_row_of_each_group(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(3)
    t, u, v, w, x, y, z = (" ".join(f"{c}{rng.randrange(10_000)}" for _ in range(80)) for c in "tuvwxyz")
    near = f"{z} changed"
    rows = [(1, t), (1, t), (2, u), (None, u), (None, v), (None, v), (5, w), (7, w), (7, x), (9, y), (9, y), (None, y), (12, z), (12, near), (11, near), (20, ""), (20, ""), (None, None)]
    docs = spark.createDataFrame([(i, s, "en", "s", 0) for i, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    alone = [(1, t), (2, u), (None, v), (5, w), (7, x), (9, y), (11, near), (20, ""), (20, ""), (None, None)]
    by = lambda r: (str(r[0]), str(r[1]))
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=by) == sorted(alone, key=by)
    left = corpus_pipeline.passages(spark, kept, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text or "") for r in left), key=by) == sorted(((i, s or "") for i, s in alone), key=by)


def test_pipeline_with_clashing_names(spark, tmp_path):
    """Columns with the names that stages use inside come through as they were."""
    import corpus_pipeline

    names = ("keep", "kept", "n_grams", "n_bytes", "others", "_row", "row", "raw", "key", "h1", "component_id", "n_shingles", "id", "body")
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(60)), "en", "s", 0) for i in range(6)]
    docs = spark.createDataFrame([*rows, (9, rows[2][1], "en", "s", 0), (10, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.col("doc_id").alias(n) for n in names])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns
    got = at.collect()
    assert sorted(r.doc_id for r in got) == [*range(6), 10]
    assert all(r[n] == r.doc_id for r in got for n in names)


@pytest.mark.parametrize("search", [top_products, nearest_products])
def test_repeated_query_rows(spark, search):
    own = [(0, [1.0, 0.0])]
    rows = [*own * 2, *[(i, [s / 100, 0.1]) for i, s in enumerate((90, 80, 70, 60, 50, 40), 1)]]
    got = search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0, 5).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(i, i) for i in range(1, 6)]
    rows = [*own * 40, *[(i, own[0][1]) for i in range(1, 9)], *[(i, [0.1, 0.9]) for i in range(20, 30)]]
    got = search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0, 5).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(i, i) for i in range(1, 6)]
    got = search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 3, 5).collect()
    assert [r.vec_id for r in got] == [0] * 5


@pytest.mark.parametrize("search", [top_products, nearest_products])
def test_longer_vectors_do_not_displace_the_others(spark, search):
    rows = [(i, [1.0, i / 10]) for i in range(6)]
    odd = [(10, [1.0, None, 1.0]), (11, [1.0, 1.0, 1.0]), (12, [float("nan")] * 9), (13, [])] + [(20 + i, [None] * 4) for i in range(9)]
    got = [search(spark.createDataFrame(x, "vec_id long, embedding array<float>"), F.col("vec_id") == 1, 3).collect() for x in (rows, rows + odd)]
    assert [(r["rank"], r.vec_id) for r in sorted(got[0])] == [(1, 5), (2, 4), (3, 3)]
    assert sorted(got[0]) == sorted(got[1])


def test_top_products_of_large_components(spark):
    rows = [(i, [9e6 + (i * 37 % 300) * 1e-2, float(-i), 2.0 * (i % 3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_products(df, F.col("vec_id") % 50 == 0, 5, group_rows=64).collect()
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    product = lambda a, b: sum(x * y for x, y in zip(ints[a], ints[b], strict=True))
    expected = []
    for q in range(0, 300, 50):
        best = sorted((-product(q, i), i) for i in ints if i != q)[:5]
        expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(expected)
    with pytest.raises(OverflowError):
        top_products(spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0)
