"""Operators over documents against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import licenses, queries
from lectern.llm.bpe import Coder, encode, merge_one
from lectern.llm.common import span_hashes
from lectern.llm.components import components
from lectern.llm.jaccard import adaptive_prefix, jaccard_components, shared_needed
from lectern.llm.packing import Ids, cuts, pack
from lectern.llm.repeats import identified, intervals, maximal_repeats, remove_repeats, repeat_groups, repeats
from lectern.llm.sharding import shard_by_bytes
from tests.llm.fixtures import CLASHING, DOCS, clash, documents

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def frame(spark, rows, clashing=False):
    if clashing:
        return spark.createDataFrame(clash(rows), CLASHING)
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)


def brute_components(rows, n, num, den):
    sets, sizes = defaultdict(list), []
    for i, text in rows:
        w = SPACE.findall(lower(text or ""))
        s = {tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))} if w else set()
        sets[i].append(s)
        sizes.append((i, len(s)))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return sorted((i, n, find(i)) for i, n in sizes)


@pytest.mark.parametrize(("n", "num", "den", "seed"), [(4, 85, 100, 0), (5, 4, 5, 1), (2, 1, 2, 2)])
def test_jaccard_components(spark, n, num, den, seed):
    rows = documents(seed)
    got = jaccard_components(frame(spark, rows, clashing=seed == 1), n, num, den).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, n, num, den)


def test_jaccard_near_copies_chain(spark):
    """A large group of near copies, and copies of copies that only a chain connects."""
    base = [f"t{i}" for i in range(100)]
    rows = []
    for i in range(80):
        base = list(base)
        base[i] = f"n{i}"
        rows.append((i + 10, " ".join(base)))
    star = [f"s{i}" for i in range(200)]
    rows += [(1000 + i, " ".join([*star[:i], f"z{i}", *star[i + 1 :]])) for i in range(0, 200, 4)]
    got = jaccard_components(frame(spark, rows), 4, 85, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 4, 85, 100)


def test_jaccard_null_key_and_empty_table(spark):
    got = jaccard_components(frame(spark, [(None, "a b c d e"), (3, "a b c d e")])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(None, None), (3, 3)}
    assert jaccard_components(frame(spark, [])).count() == 0


def test_jaccard_words_that_a_polynomial_hash_confuses(spark):
    word = "a"
    while len(word) < 1024:
        word += word.translate({97: 98, 98: 97})
    rows = [(1, word), (2, word.translate({97: 98, 98: 97})), (3, word)]
    assert {(r.doc_id, r.component_id) for r in jaccard_components(frame(spark, rows)).collect()} == {(1, 1), (2, 2), (3, 1)}


def test_jaccard_crowded_lists(spark):
    """Lists dealt to several tasks lose no link."""
    rows = documents(1)
    common = [f"c{i}" for i in range(40)]
    rows += [(5000 + i, " ".join([*common[: i % 40], f"z{i}", *common[i % 40 + 1 :]])) for i in range(60)]
    got = jaccard_components(frame(spark, rows), 4, 85, 100, buckets=64, crowd=3).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 4, 85, 100)


def test_jaccard_id_of_two_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, b), (4, c), (3, c), (9, f"{b} more"), (0, a), (0, a)]
    got = jaccard_components(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 5, 4, 5)


def test_span_hashes():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    start = rng.integers(0, 2900, 4000)
    end = start + rng.integers(0, 90, 4000)
    spans = [data[a:b].tobytes() for a, b in zip(start, end, strict=True)]
    assert len(set(zip(spans, span_hashes(data, start, end).tolist(), strict=True))) == len(set(spans)) == len(set(span_hashes(data, start, end).tolist()))


def test_prefix_arithmetic():
    for a in range(1, 40):
        for b in range(1, 40):
            least = shared_needed(a, b, 85, 100)
            assert 100 * least >= 85 * (a + b - least)
            assert 100 * (least - 1) < 85 * (a + b - (least - 1))
    assert adaptive_prefix(np.array([1.0, 1, 1, 1]), 1, 4, 0.2) == 1
    assert adaptive_prefix(np.array([1000.0, 1, 1, 1]), 1, 4, 0.2) > 1


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 50)] + [(100, 90), (90, 95), (7, 7)] + [(200, 200 + i) for i in range(1, 40)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {tuple(r) for r in components(df).collect()}
    assert got == {tuple(r) for r in components(df.repartition(4), partition_rows=20).collect()}
    assert got == {(i, 0) for i in range(51)} | {(90, 90), (95, 90), (100, 90)} | {(200 + i, 200) for i in range(40)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows, least):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + least] for _, t in texts for p in range(len(t) - least + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - least + 1):
            if seen[t[p : p + least]] > 1:
                gone[p : p + least] = b"\x01" * least
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_remove_repeats(spark, seed):
    rows = documents(seed)
    got = remove_repeats(frame(spark, rows, clashing=seed == 1), 200).withColumn("sha", F.sha2("kept", 256)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got) == brute_repeats(rows, 200)


def test_remove_repeats_small_alphabet(spark):
    """Many overlapping repeats with different ends on both sides."""
    rng = np.random.default_rng(5)
    blocks = ["".join(rng.choice(list("ab"), 90)) for _ in range(6)]
    rows = [(i, "".join(blocks[j] for j in rng.integers(0, 6, 8)) + str(i)) for i in range(40)] + [(99, "é" * 150), (98, "é" * 110 + "e")]
    got = remove_repeats(frame(spark, rows), 200).withColumn("sha", F.sha2("kept", 256)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got) == brute_repeats(rows, 200)
    whole = remove_repeats(frame(spark, rows), 200, whole_characters=True).collect()
    for r in whole:
        r.kept.decode()


def test_remove_repeats_crowded_anchor(spark):
    """Anchors split by longer shared strings give the same bytes."""
    rng = np.random.default_rng(5)
    line = "".join(rng.choice(list("abcdefgh"), 190))
    rows = [*documents(3), *[(1000 + i, f"{''.join(rng.choice(list('xyz'), 40))}{line}{'q' * (i % 9)}{''.join(rng.choice(list('uvw'), 40))}") for i in range(60)]]
    raw = identified(frame(spark, rows), "text")
    texts = {(r.h1, r.h2): r.text.encode() for r in raw.collect()}

    def covered(most):
        out = defaultdict(set)
        for r in repeats(raw, 200, most_contexts=most)[0].collect():
            out[r.h1, r.h2] |= set(range(r.start, r.end))
        return out

    few, many = covered(50_000), covered(1)
    assert few == many
    assert any(line.encode() in texts[h] for h in few)


def test_remove_repeats_empty_and_null_key(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
    text = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(300))
    assert sorted(r.n_removed for r in remove_repeats(frame(spark, [(None, text), (1, text), (None, "y" + text)])).collect()) == [300, 300, 300]


def test_remove_repeats_names_and_many_null_keys(spark):
    names = ("kept", "n_bytes", "raw", "others", "h1", "_key", "body", "spans", "copied")
    rows = documents(2)
    df = frame(spark, [(None, t) for _, t in rows]).select("*", *[F.lit(7).alias(n) for n in names])
    got = remove_repeats(df, 200).withColumn("sha", F.sha2("kept", 256))
    assert got.columns == [c for c in df.columns if c not in ("kept", "n_bytes")] + ["kept", "n_bytes", "n_removed", "n_spans", "sha"]
    expected = sorted((None, *r[1:]) for r in brute_repeats([(0, t) for _, t in rows], 200))
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got.collect()) == expected


def test_maximal_repeats():
    texts = ["xabcdefg1", "yabcdefg2", "zabcdeh", "zabcdei"]
    at = 3  # the anchor is "cd"
    pairs = sorted((t[at:].encode(), t[:at][::-1].encode()) for t in texts)
    found = {(pairs[m[0]][1][:l][::-1] + pairs[m[0]][0][:r], len(m)) for l, r, m in maximal_repeats([p[0] for p in pairs], [p[1] for p in pairs], 4)}
    assert found == {(b"abcdefg", 2), (b"abcde", 4), (b"zabcde", 2)}
    assert [(n, a, b) for n, a, b, _ in intervals([0, 2, 3, 1], 1)] == [(3, 1, 3), (2, 0, 3), (1, 0, 4)]


def brute_groups(rows, least):
    """{(string, places)}: all maximal repeats by definition."""
    places = defaultdict(set)
    texts = [(i, n, (t or "").encode()) for n, (i, t) in enumerate(rows)]
    for i, n, t in texts:
        for a in range(len(t)):
            for b in range(a + least, len(t) + 1):
                places[t[a:b]].add((i, n, a))
    known = {n: t for _, n, t in texts}
    out = Counter()
    for string, at in places.items():
        if len(at) > 1:
            before = {known[n][a - 1 : a] or n for _, n, a in at}
            behind = {known[n][a + len(string) : a + len(string) + 1] or n for _, n, a in at}
            if len(before) > 1 and len(behind) > 1:
                out[string, tuple(sorted((i, a) for i, _, a in at))] += 1
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_repeat_groups(spark, seed):
    """All maximal repeats with all their places, exact copies and repeats of many anchors included."""
    rng = random.Random(seed)
    blocks = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 30))) for _ in range(5)]
    rows = [(i, "".join(rng.choice(blocks) for _ in range(rng.randrange(1, 5))) + rng.choice(["", "c", "é"])) for i in range(14)]
    rows += [(50, rows[0][1]), (50, rows[0][1]), (51, "x" + rows[1][1]), (52, None), (53, ""), (54, "a" * 30), (55, "".join(blocks) + "z"), (56, "".join(blocks))]
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append((t or "").encode())
    groups = defaultdict(list)
    for r in repeat_groups(frame(spark, rows), 16, 8).collect():
        assert not r.open
        groups[r.anchor, r.group, r.length].append((r.doc_id, r.start))
    got = Counter()
    for (_, _, length), at in groups.items():
        strings = {t[s : s + length] for i, s in at for t in texts[i] if len(t) >= s + length}
        assert len(strings) == 1
        got[strings.pop(), tuple(sorted(at))] += 1
    assert got == brute_groups(rows, 16)
    assert repeat_groups(frame(spark, []), 16, 8).count() == 0


def test_repeat_groups_beyond_reach(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(900))
    rows = [(1, "1" + text), (2, "2" + text + "y"), (3, text[100:])]
    groups = defaultdict(set)
    for r in repeat_groups(frame(spark, rows), 200, 32).collect():
        groups[r.length, r.open].add((r.doc_id, r.start))
    assert groups == {(900, False): {(1, 1), (2, 1)}, (800, False): {(1, 101), (2, 101), (3, 0)}}
    assert {r.open for r in repeat_groups(frame(spark, rows), 200, 32, reach=300).collect()} == {True}


def test_pack(spark):
    from tokenizers import Tokenizer

    rows = [*documents(1), (900, "a <|endoftext|> b<|endoftext|>"), (901, "<|endoftext|>" * 700)]
    got = pack(frame(spark, rows, clashing=True), queries.vocabulary("byte_bpe_50k.json"), queries.pattern()).toPandas()
    plain = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    expected = Counter((i, tuple([*plain.encode(t or "", add_special_tokens=False).ids, 0])) for i, t in rows)
    for (i, ids), times in expected.items():
        own = got[got.doc_id == i]
        assert set(own.doc_tokens) == {len(ids)}
        pieces = Counter(zip(own.start, own.length, own.ids_crc32, strict=True))
        assert set(pieces.values()) == {times}
        at = 0
        for start, length, crc in sorted(pieces):
            assert start == at
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    padding = 0
    assert sorted(got.sequence_id.unique()) == list(range(got.sequence_id.nunique()))
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert (own.offset.to_numpy() == np.concatenate([[0], own.length.cumsum().to_numpy()[:-1]])).all()
        used = own.length.sum()
        assert used <= 1024
        padding += 0 if used & (used - 1) == 0 else 1024 - used
    assert padding < 0.02 * got.length.sum()
    assert pack(frame(spark, []), queries.vocabulary("byte_bpe_50k.json"), queries.pattern()).count() == 0


def test_same_ids_as_the_tokenizer():
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    for added in (True, False):
        plain.encode_special_tokens = not added
        ids = Ids(path, queries.pattern(), added)
        for text in ["", " ", "a  b\n\n c\t d", "a <|endoftext|> b", "<|endoftext|>", "<|endof", "I'll we've 'S", "日本語 текст ñ😀​", "x" * 3000, " " * 500, "\r\n\x00\x1f", "١٢٣ ½ Ⅷ"]:
            assert ids(text) == plain.encode(text, add_special_tokens=False).ids
    assert Ids(path, queries.pattern())("a <|endoftext|> b") == [64, 220, 50256, 275]


@pytest.mark.parametrize("run", [" " * 1_000_000, "\n" * 1_000_000, "\u00a0 \t" * 400_000, "a  b " + "\r\n" * 500_000])
def test_long_white_space(spark, run):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    rows = [(1, run + "x <|endoftext|>"), (2, "x  y" + run), (3, "short")]
    got = pack(frame(spark, rows), queries.vocabulary("byte_bpe_50k.json"), queries.pattern()).collect()
    for i, text in rows:
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r.start, r.length, r.ids_crc32) for r in got if r.doc_id == i)
        assert sum(n for _, n, _ in own) == len(ids)
        assert all(crc == zlib.crc32(ids[a : a + n].tobytes()) for a, n, crc in own)


def test_pipeline_by_brute_force(spark, tmp_path):
    """run() against near copies, repeated passages and token ids from their definitions; labels of both kinds decide nothing here, as none are given."""
    from tokenizers import Tokenizer

    import corpus_pipeline

    rows = documents(5)
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    numbered = list(enumerate(rows))
    component = {n: c for n, _, c in brute_components([(n, t) for n, (_, t) in numbered], 5, 4, 5)}
    best = {}
    for n, (i, text) in numbered:
        if SPACE.search(text or ""):
            best[component[n]] = min(best.get(component[n], (i, n)), (i, n))
    kept = [(i, text) for n, (i, text) in numbered if not SPACE.search(text or "") or best[component[n]] == (i, n)]
    assert 20 < len(kept) < len(rows) - 10
    raw = [(i, (t or "").encode()) for i, t in kept]
    seen = Counter(t[p : p + 200] for _, t in raw for p in range(len(t) - 199))
    plain, expected = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json")), Counter()
    for i, t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - 199):
            if seen[t[p : p + 200]] > 1:
                gone[p : p + 200] = b"\x01" * 200
        chars = [(p, len(c.encode())) for p, c in zip(np.cumsum([0, *[len(c.encode()) for c in t.decode()]]).tolist(), t.decode(), strict=False)]
        left = "".join(t[p : p + n].decode() for p, n in chars if not all(gone[p : p + n]))
        expected[i, tuple([*plain.encode(left, add_special_tokens=False).ids, 0])] += 1
    assert any(len(ids) > 1 for _, ids in expected)
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for (i, ids), times in expected.items():
        data = np.array(ids, "<u4")
        own = [x for x in pieces[i] if x[3] == len(ids) and x[2] == zlib.crc32(data[x[0] : x[0] + x[1]].tobytes())]
        assert sum(x[1] for x in own) >= times * len(ids)
    assert sum(x[1] for own in pieces.values() for x in own) == sum(len(ids) * n for (_, ids), n in expected.items())


def test_cuts():
    for n in range(1, 4000):
        own = cuts(n, 1024, 64)
        assert sum(own) == n
        assert all(x == 1024 or x < 64 or x & (x - 1) == 0 for x in own)


def test_encode(spark):
    import tiktoken

    from lectern.llm.bpe import load_ranks

    rows = [*documents(2), (900, "<|endoftext|> I'll \r\n  x  ñandú 日本語 text 😀😀"), (901, "a" * 5000), (902, "abab" * 999 + " " * 700), (903, "\x00\x01")]
    path = queries.vocabulary("byte_bpe_multi_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=queries.pattern(), mergeable_ranks=load_ranks(path), special_tokens={})
    got = encode(frame(spark, rows, clashing=True), path, queries.pattern()).collect()
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == Counter((i, np.array(plain.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows)
    assert encode(frame(spark, []), path, queries.pattern()).count() == 0


def test_replay_is_the_definition():
    coder = Coder(queries.vocabulary("byte_bpe_multi_50k.tiktoken"), queries.pattern())
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abcdeent iongérsth"), 40)) for _ in range(300)]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        expected = [i for w in coder.split(text) for i in merge_one(w.encode(), coder.pairs.ranks)]
        assert np.frombuffer(ids, "<u4").tolist() == expected


def test_shards(spark):
    rows = documents(0)
    for parts in (None, 5):
        got = shard_by_bytes(frame(spark, rows, clashing=True), 4, partitions=parts).toPandas()
        size = lambda t: len((t or "").encode()) + 1
        assert Counter(zip(got.doc_id, got["size"], got.text_crc32, strict=True)) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
        total, at = sum(size(t) for _, t in rows), 0
        expected = []
        for i, t in sorted(rows, key=lambda r: r[0]):
            expected.append((i, min(3, (2 * at + size(t)) * 4 // (2 * total))))
            at += size(t)
        assert sorted(zip(got.doc_id, got.shard, strict=True)) == sorted(expected)
        for _, own in got.groupby("shard"):
            assert sorted(own.slot) == list(range(len(own)))
    assert shard_by_bytes(frame(spark, []), 4).count() == 0


def test_license_scan(spark):
    mit = licenses.TEMPLATES["mit"]
    broken = mit.replace("free of charge", "at no  cost").replace("sublicense", "relicense").upper()
    rows = [(1, f"é {mit} tail"), (2, f"head\n{broken}"), (3, "Released under the terms of MIT licences"), (4, None), (5, ""), (6, "foo Released under the MIT\nLicense. bar " * 3), (7, mit[:200]), (1, f"é {mit} tail"), (8, "x " * 30_000)]
    got = licenses.scan_licenses(frame(spark, rows, clashing=True)).collect()
    found = Counter((r.doc_id, r.template) for r in got)
    assert found == {(1, "mit"): 2, (2, "mit"): 1, (6, "mit-notice"): 3}
    exact = next(r for r in got if r.doc_id == 1)
    assert (exact.coverage, rows[0][1][exact.start : exact.end]) == (1.0, mit.rstrip("."))
    changed = next(r for r in got if r.doc_id == 2)
    assert 0.9 < changed.coverage < 1
    assert licenses.scan_licenses(frame(spark, [])).count() == 0
    assert licenses.scan_licenses(frame(spark, rows), templates={}).count() == 0


def test_license_scan_by_brute_force(spark):
    """Against all templates aligned at all places, without fingerprints, on texts with changed, missing and added words."""
    rng = random.Random(8)
    spoken = {name: re.findall(r"[^\W_]+", t.lower()) for name, t in licenses.TEMPLATES.items()}
    rows = []
    for i in range(40):
        text = []
        for name in rng.sample(sorted(spoken), 2):
            text += [f"w{rng.randrange(50)}" for _ in range(rng.randrange(12))]
            for w in spoken[name]:
                change = rng.random() if i % 4 else 1.0
                text += [] if change < 0.04 else ["zzz"] if change < 0.08 else [w, "added"] if change < 0.1 else [w]
        rows.append((i, text))
    got = {(r.doc_id, r.template): 0 for r in licenses.scan_licenses(frame(spark, [(i, " ".join(w)) for i, w in rows])).collect()}
    for r in licenses.scan_licenses(frame(spark, [(i, " ".join(w)) for i, w in rows])).collect():
        got[r.doc_id, r.template] = max(got[r.doc_id, r.template], r.matched_words)
    expected = {}
    for i, words in rows:
        text = [hash(w) for w in words]
        for name, own in spoken.items():
            template, wide = np.array([hash(w) for w in own]), 2 * max(1, min(8, len(own) // 4))
            best = max(licenses.banded(template, text, shift, wide)[0] for shift in range(-len(own), len(text), max(1, wide // 2)))
            if best >= 0.8 * len(own):
                expected[i, name] = best
    assert set(got) == set(expected)
    assert all(got[k] >= 0.8 * len(spoken[k[1]]) and got[k] <= expected[k] for k in got)


def test_every_notice_is_found(spark):
    rows = [(i, f"some words before. {t} and some words behind") for i, t in enumerate(licenses.TEMPLATES.values())]
    got = {(r.doc_id, r.template): r.coverage for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    for i, name in enumerate(licenses.TEMPLATES):
        assert got[i, name] == 1.0


def test_every_notice_is_found_with_any_word_changed(spark):
    spoken = {name: re.findall(r"[^\W_]+", t) for name, t in licenses.TEMPLATES.items()}
    changed = [(name, [*w[:i], "zzz", *w[i + 1 :]]) for name, w in spoken.items() for i in range(len(w))]
    inserted = [("mit-notice", "Released right under the new MIT big License".split()), ("cc-by-nc-4.0-notice", "Licensed truly under CC then BY NC now 4 0".split())]
    cases = [*changed, *inserted]
    got = {(r.doc_id, r.template): r.matched_words for r in licenses.scan_licenses(frame(spark, [(i, " ".join(["before", "it", *w, "behind"])) for i, (_, w) in enumerate(cases)])).collect()}
    for i, (name, w) in enumerate(cases):
        template, text = (np.array([hash(x.lower()) for x in side]) for side in (spoken[name], ["before", "it", *w, "behind"]))
        band = 2 * max(1, min(8, len(template) // 4))
        best = max(licenses.banded(template, text.tolist(), shift, band)[0] for shift in range(-2, 6))
        assert best >= 0.8 * len(template)
        assert got.get((i, name)) == best, (name, w)
