"""Centroid clustering, ranked lexical search, robust quality rules: each against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lectern.llm.centroids import cluster_vectors, nearest
from lectern.llm.outliers import LEAST_SPREAD, quality_rules
from lectern.llm.ranked import Shard, block_starts, rank_documents, search
from lectern.llm.repeats import remove_repeats
from lectern.llm.srs import chi_square_below, chi_square_quantile


def lloyd(rows, k, rounds, dims, seed=2):
    """Clusters, distances and centroids by the definition, in Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    for last in [False] * rounds + [True]:
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]
        if not last:
            for j in range(len(centroids)):
                own = [v for (_, v), (_, c) in zip(kept, found, strict=True) if c == j]
                if own:
                    centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return sorted(((i, c, d, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, found, strict=True)), key=str)


@pytest.mark.parametrize("k", [1, 7, 500])
def test_clusters_by_brute_force(spark, k):
    rng = random.Random(k)
    centres = [[rng.uniform(-1, 1) for _ in range(12)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in centres[i % 5]]) for i in range(200)]
    rows += [(200, None), (201, []), (202, [1.0] * 11), (203, [1.0] * 11 + [None]), (204, [math.nan] * 12), (205, [math.inf] * 12), (None, [0.5] * 12), rows[3], rows[3], (3, [0.1] * 12)]
    rows += [(300 + i, [0.25] * 12) for i in range(80)]  # ties and a crowd of equal vectors
    table = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<double>, cluster int, v int, n int").repartition(5)
    got = cluster_vectors(table, k=k, rounds=3, dims=12).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got), key=str) == lloyd(rows, k, 3, 12)
    assert {r.inertia for r in got} == {sum(r.distance for r in got)}
    for r in got:
        assert r.cluster_inertia == sum(x.distance for x in got if x.cluster == r.cluster)


def test_partial_distances_skip_work_and_keep_ties():
    rng = np.random.default_rng(0)
    centroids = rng.integers(-300, 300, (40, 64))
    centroids[7] = centroids[3]
    x = centroids[rng.integers(0, 40, 500)] + rng.integers(-20, 20, (500, 64))
    report = {}
    cluster, distance = nearest(x, centroids, report=report)
    full = ((x[:, None] - centroids[None]) ** 2).sum(2)
    assert (cluster == full.argmin(1)).all()
    assert (distance == full.min(1)).all()
    assert report["differences"] < 0.3 * report["of"]


def test_clusters_of_nothing_and_of_too_much(spark):
    assert cluster_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert cluster_vectors(spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")).count() == 0
    with pytest.raises(OverflowError):
        cluster_vectors(spark.createDataFrame([(1, [1e12, 0.0]), (2, [-1e12, 0.0])], "vec_id long, embedding array<double>"), dims=2)
    big = spark.createDataFrame([(1, [1e12, 0.0]), (2, [1e12, 1.0])], "vec_id long, embedding array<double>")
    assert [r.distance for r in cluster_vectors(big, k=2, dims=2).collect()] == [0, 0]


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def ranked(docs, items, k):
    """Scores of all documents by the definition."""
    terms = [(i, re.findall(TERM, lowered(t))) for i, t in docs]
    terms = [(i, t) for i, t in terms if t]
    n_docs, n_terms = len(terms), sum(len(t) for _, t in terms)
    df = Counter(t for _, ts in terms for t in set(ts))
    out = []
    for item in {i for i, t in items if t is not None}:
        asked = re.findall(TERM, lowered(min(t for i, t in items if i == item and t is not None)))
        scores = []
        for i, ts in terms:
            tf, m = Counter(ts), 100 - 25 + (25 * len(ts) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in asked if tf[t])
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("shard_docs", "item_bytes"), [(65_536, 8 << 20), (7, 60)])
def test_ranked_by_brute_force(spark, shard_docs, item_bytes):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ä", "é9", "ЖЖ"]
    pick = lambda n: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(63)], k=n))
    docs = [(i, pick(rng.choice([1, 3, 20, 200])).replace("w1 ", "W1_w1-")) for i in range(150)]
    docs += [(150, None), (151, ""), (152, " ._\x7f"), (None, docs[0][1]), (None, docs[5][1]), docs[3], docs[3], (153, "w1 " * 30_000), *[(400 + i, docs[9][1]) for i in range(60)]]
    items = [(i, pick(rng.choice([1, 5, 40]))) for i in range(12)] + [(20, None), (21, ""), (22, "unseen words"), (3, "w50 w51"), (24, docs[9][1]), (None, "w2 w3")]
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, item int").repartition(3)
    asked = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id int, text string, rank int")
    got = rank_documents(table, asked, 20, shard_docs=shard_docs, item_bytes=item_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked(docs, items, 20)


def test_ranked_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r) for r in rank_documents(docs, items).collect()] == [(1, 1, 1, math.floor(1000 * math.log(4 / 3)) * (10**9 // (1000 + 12 * 100)))]
    assert rank_documents(docs.limit(0), items).count() == 0
    assert rank_documents(docs, items.limit(0)).count() == 0


def test_blocks_minimise_the_error_of_their_bounds():
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.integers(1, 1000, n) for n in (40, 1, 25)])
    first, length = np.array([0, 40, 41, 66]), np.array([40, 1, 25, 0])
    marks = block_starts(values, first, length, block_cost=3, longest=10)
    for a, n in zip(first, length, strict=True):
        own = values[a : a + n]
        if not n:
            continue
        cost = 3 * own.std()
        error = lambda i, j, own=own, cost=cost: (j - i) * own[i:j].max() - own[i:j].sum() + cost
        least = [0.0]
        for j in range(1, n + 1):
            least.append(min(least[i] + error(i, j) for i in range(max(0, j - 10), j)))
        cuts = [*np.flatnonzero(marks[a : a + n]), n]
        assert cuts[0] == 0
        assert sum(error(i, j) for i, j in zip(cuts, cuts[1:], strict=False)) == pytest.approx(least[-1])


def test_search_skips_blocks():
    rng = np.random.default_rng(3)
    size, docs, terms, values = 20_000, [], [], []
    for t, share in enumerate([0.5, 0.3, 0.01, 0.002]):
        own = np.flatnonzero(rng.random(size) < share)
        docs.append(own), terms.append(np.full(len(own), t)), values.append((rng.pareto(2, len(own)) * 1000).astype(np.int64) + 1)
    shard = Shard.of(*(np.concatenate(x) for x in (docs, terms, values)), 5, size)
    weights, report = np.array([10, 20, 500, 900, 7]), {}
    found, scores = search(shard, np.arange(5), weights, 20, report=report)
    full = np.zeros(size, np.int64)
    for t in range(4):
        full[docs[t]] += weights[t] * values[t]
    best = np.sort(full)[::-1][:20]
    assert (np.sort(scores)[::-1][:20] == best).all()
    assert (full[found] == scores).all()
    assert set(np.flatnonzero(full >= best[-1])) <= set(found.tolist())
    assert report["scored"] < 0.1 * size


def counts_of(text):
    text = text or ""
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, inside = Counter(runs), set()
    for i, r in enumerate(runs):
        if often[r] > 1:
            inside |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def mcd(x, share, spread, rng):
    """The reweighted estimate of the best of many starts, each concentrated until it stands."""
    p, n = x.shape[1], len(x)
    h, ridge = math.ceil(share * n), np.diag(spread**2)
    scale = share / chi_square_below(chi_square_quantile(share, p), p + 2)
    best = None
    for _ in range(60):
        own = x[rng.choice(n, p + 1, replace=False)]
        mean, cov = own.mean(0), np.cov(own.T, bias=True) + ridge
        for _ in range(15):
            d = ((x - mean) @ np.linalg.inv(cov) * (x - mean)).sum(1)
            own = x[np.argsort(d)[:h]]
            mean, cov = own.mean(0), scale * np.cov(own.T, bias=True) + ridge
        if best is None or np.linalg.det(cov) < best[0]:
            best = np.linalg.det(cov), mean, cov
    _, mean, cov = best
    near = chi_square_quantile(0.975, p)
    own = x[((x - mean) @ np.linalg.inv(cov) * (x - mean)).sum(1) <= near]
    mean, cov = own.mean(0), 0.975 / chi_square_below(near, p + 2) * np.cov(own.T, bias=True) + ridge
    return mean, cov


def test_quality_rules_by_brute_force(spark):
    rng = random.Random(1)
    word = lambda a, b: "".join(rng.choices("abcdefgh", k=rng.randrange(a, b)))
    clean = lambda a, b: "\n".join(" ".join(word(a, b) for _ in range(rng.randrange(5, 15))) for _ in range(rng.randrange(8, 30)))
    rows = [(i, clean(2, 7), "en", "s1") for i in range(160)] + [(200 + i, clean(5, 12), "de", f"s{i % 9}") for i in range(120)]
    rows += [(400 + i, "# $% " * 60 + clean(2, 7), "en", "s1") for i in range(25)]  # many symbols
    rows += [(450 + i, " ".join(word(25, 40) for _ in range(80)), "de", "s2") for i in range(10)]  # long words
    copied = clean(2, 7)
    rows += [(500 + i, copied, "en", "s1") for i in range(200)]
    rows += [(700, None, "en", "s1"), (701, "", None, None), (702, " \n\t", "en", None), (703, clean(2, 7), None, "s1"), (704, "a b c " * 40, "en", "s1"), (705, "one line here\n" * 30, "en", "s1"), rows[0], (None, rows[1][1], "en", "s1")]
    rows += [(706, "x y z " + " ".join(word(4, 9) for _ in range(60)) + " x y z\x0b\x0c\r x y", "en", "s1"), (707, "é€😀 " * 3 + clean(2, 7), "en", "s1"), (708, "a b a b a " + clean(2, 7), "en", "s1"), (709, clean(2, 7) * 300, "en", "s1")]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], "doc_id long, text string, lang string, source string, n_words int, kept int, x0 int, pool int, level0 int").repartition(5)
    got = sorted(quality_rules(docs).collect(), key=str)
    numbers = [counts_of(t) for _, t, _, _ in rows]
    failed = [n[0] < 50 or 100 * n[4] > 50 * n[0] for n in numbers]
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == sorted(((i, *n, f) for (i, *_), n, f in zip(rows, numbers, failed, strict=True)), key=str)
    vectors = {}
    for (i, _, lang, source), n, f in zip(rows, numbers, failed, strict=True):
        if not f:
            x = [math.log(n[1] / n[0]), math.sqrt(n[2] / n[0]), math.sqrt(n[3] / n[0]), math.sqrt(n[4] / n[0]), math.log(n[0])]
            vectors.setdefault("en" if (lang, source) == ("en", "s1") else "de" if lang == "de" else None, []).append((i, [round(1000 * v) for v in x]))
    judged = {r.doc_id: r for r in got if r.doc_id is not None}
    spread = 1000 * np.array(LEAST_SPREAD)
    edge = chi_square_quantile(0.9999, 5)
    for pool, own in vectors.items():
        if pool is None:  # too few to judge by
            assert all(judged[i].kept and judged[i].distance is None for i, _ in own)
            continue
        mean, cov = mcd(np.unique([v for _, v in own], axis=0).astype(float), 0.75, spread, np.random.default_rng(0))
        for i, v in own:
            d = float((v - mean) @ np.linalg.inv(cov) @ (v - mean))
            if i is not None:
                assert judged[i].distance == pytest.approx(d, rel=0.15, abs=0.3)
                if abs(d - edge) > 0.2 * edge:
                    assert judged[i].kept == (d <= edge)
    assert all(judged[i].kept for i in [*range(160), *range(200, 320), *range(500, 700)])
    assert not any(judged[i].kept for i in [*range(400, 425), *range(450, 460), 700, 701, 702, 704, 705])


def test_quality_rules_of_few_and_of_equal_rows(spark):
    schema = "doc_id long, text string, lang string, source string"
    assert quality_rules(spark.createDataFrame([], schema)).count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    few = quality_rules(spark.createDataFrame([(1, text, "en", "a"), (2, "short", "en", "a")], schema)).orderBy("doc_id").collect()
    assert [(r.base_failed, r.distance, r.kept) for r in few] == [(False, None, True), (True, None, False)]
    equal = quality_rules(spark.createDataFrame([(i, text + " more" * (i % 2), "en", "a") for i in range(40)], schema), least_points=1).collect()
    assert all(r.kept and r.distance is not None for r in equal)


def removed(raw, least):
    """(bytes left, runs) of a text by the definition, strings told apart by Python's hashes of a byte's window."""
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), least)
    keys = np.zeros(len(windows), np.uint64)
    for j in range(least):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + windows[:, j] + np.uint64(1)
    _, where, counts = np.unique(keys, return_inverse=True, return_counts=True)
    edges = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(counts[where] > 1), 1)
    np.add.at(edges, np.flatnonzero(counts[where] > 1) + least, -1)
    gone = np.cumsum(edges)[:-1] > 0
    return int((~gone).sum()), int(np.count_nonzero(gone & ~np.append(False, gone[:-1])))


def test_long_texts_of_little_variety_and_long_texts_in_stretches(spark):
    rng = np.random.default_rng(4)
    long = rng.integers(97, 123, 4_300_000).astype(np.uint8)
    for a, b, n in ((2_097_000, 10, 400), (2_097_152 - 199, 5000, 200), (2_097_152 - 200, 9000, 199), (4_194_304 - 100, 2_000_000, 350)):
        long[a : a + n] = long[b : b + n]
    rows = [(1, "a" * 3_000_000), (2, "abcdefg" * 500_000 + "x"), (3, bytes(long).decode()), (4, "yyz" * 67), (5, "ab" * 101 + "c")]
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), 200).collect()}
    assert (got[1].n_removed, got[1].n_spans) == (3_000_000, 1)
    assert (got[2].n_removed, got[2].n_spans, bytes(got[2].kept)) == (3_500_000, 1, b"x")
    assert (len(got[3].kept), got[3].n_spans) == removed(bytes(long), 200)
    assert got[3].n_removed > 1000
    assert got[4].n_removed == 0
    assert (got[5].n_removed, bytes(got[5].kept)) == (202, b"c")


def test_what_repeats_at_every_byte_is_a_row_or_two(spark):
    from lectern.llm.repeats import identified, sampled

    texts = spark.createDataFrame([(1, "a" * 500_000), (2, "abc" * 200_000), (3, " ".join(map(str, range(5000))))], "doc_id long, text string").coalesce(1)
    rows = sampled(identified(texts, "text"), 200, 32)
    plain = sampled(identified(texts.where("doc_id = 3"), "text"), 200, 32).count()
    assert rows.count() < plain + 20
