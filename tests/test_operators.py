"""Operators against folds in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import integrity, ordered, paging, project, relations, resolve


def test_resolver_chain(spark):
    rows = [(0, 72.0, None, None), (1, None, {"a": 1.0, "b": 2.0}, 3.0), (2, None, {"a": None}, 2.0), (3, None, None, None), (4, None, {}, None), (5, None, {"a": None}, None)]
    df = spark.createDataFrame(rows, "i int, total double, parts map<string,double>, credits double")
    chain = resolve.build_chain([("direct", (F.col("total"),)), ("sum_components", (F.col("parts"),)), ("credits_to_hours", (F.col("credits"),))])
    got = {r.i: r.r for r in df.select("i", chain.alias("r")).collect()}
    assert [(got[i].value, got[i].status, got[i].method) for i in range(6)] == [
        (72.0, "published", "direct"), (3.0, "derived", "sum_components"), (72.0, "derived", "credits_to_hours"),
        (None, "not_published", "credits_to_hours"), (None, "not_published", "credits_to_hours"), (None, "not_published", "credits_to_hours"),
    ]
    assert got[2].warnings == ["hours derived from credits"]
    last = df.select(resolve.chain(resolve.sum_components(F.col("parts"))).alias("r")).collect()
    assert last[2].r.status == "invalid"
    assert df.select(resolve.chain().alias("r")).first().r.method == "chain"
    ambiguous = resolve.resolution(None, "ambiguous", "mine", 0.2)
    custom = resolve.build_chain([("direct", (F.col("total"),)), ("credits_to_hours", ())], {"direct": lambda c: ambiguous, "credits_to_hours": lambda: ambiguous})
    assert df.select(custom.alias("r")).first().r.method == "mine"
    with pytest.raises(ValueError):
        resolve.build_chain([("nothing", ())])


def test_resolvers_of_text(spark):
    df = spark.createDataFrame([("40",), ("abc",), ("",), (None,)], "c string")
    for resolver, name in ((resolve.direct, "total_hours"), (resolve.credits_to_hours, "credits")):
        got = [r.r for r in df.select(resolver(F.col("c")).alias("r")).collect()]
        assert [(r.status, r.value) for r in got] == [("invalid", None)] * 2 + [("not_published", None)] * 2
        assert got[0].warnings == [f"{name} is not numeric"]
    assert spark.range(4, 5).select(resolve.credits_to_hours(F.col("id")).alias("r")).first().r.value == 144


def _followed(pairs, value, kind):
    seen = set()
    while value not in seen:
        seen.add(value)
        onward = pairs.get((kind, value), pairs.get(("", value)))
        if onward is None:
            break
        value = onward
    return value


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_alias_closure_by_following(spark, seed):
    """Chains, tails into cycles, cycles and typed links before untyped ones, against links followed one by one."""
    rng = random.Random(seed)
    rows = [("", f"n{i}", f"n{rng.randrange(40)}") for i in range(30)] + [(k, f"n{i}", f"n{rng.randrange(40)}") for k in ("a", "b") for i in range(0, 40, 3)]
    rows += [(None, f"c{i}", f"c{i + 1}") for i in range(100)]
    pairs = {(k or "", a): t for k, a, t in rows}
    got = {(r.entity_type, r.alias): r.target for r in relations.alias_closure(spark.createDataFrame(rows, "entity_type string, alias string, target string")).collect()}
    known = {(k, a) for k in ("", "a", "b") for k2, a in pairs if k2 in ("", k)}
    assert got == {(k, a): _followed(pairs, a, k) for k, a in known}
    plain = spark.createDataFrame([(a, t) for k, a, t in rows if not k], "alias string, target string")
    assert {r.alias: r.target for r in relations.alias_closure(plain).collect()} == {a: _followed(pairs, a, "") for k, a in pairs if not k}
    assert relations.alias_closure(plain.limit(0)).count() == 0


def test_provenance(spark):
    rows = [("k", 1, "", ["s1", "s2"]), ("k", 2, "u", ["s2", "s3"]), ("k", 3, "v", None), ("m", 1, None, None)]
    df = spark.createDataFrame(rows, "k string, o int, url string, sources array<string>")
    got = {r.k: (r.url, r.sources) for r in relations.merge_provenance(df, ["k"], ["url"], "o").collect()}
    assert got == {"k": ("u", ["s1", "s2", "s3"]), "m": (None, [])}


def test_entity_index(spark):
    rows = [("a", "101", "Алгебра", "d", "x"), ("b", "101", " алгебра", "d", "y"), ("c", "202", "Физика", "d", "x"), ("e", "202", "Механика", "d", "x"), ("f", "", "", "d", "x"), ("g", None, "Право", "d", None)]
    out = {k: v.collect() for k, v in integrity.entity_index(spark.createDataFrame(rows, "id string, code string, name string, department string, document_id string"), "plan").items()}
    by = {r.value: r for r in out["entities"]}
    assert len(by) == 5
    assert (by["101|алгебра"].status, by["101|алгебра"].aliases, by["101|алгебра"].n, by["101|алгебра"].n_documents) == ("ambiguous", ["Алгебра", "алгебра"], 2, 2)
    assert by["202|физика"].status == "resolved"
    assert sorted(r.kind for r in out["entities"]) == ["code_name", "code_name", "code_name", "name_department", "source"]
    assert sorted((r.code, r.n_names, r.names) for r in out["collisions"]) == [("101", 2, ["Алгебра", "алгебра"]), ("202", 2, ["Механика", "Физика"])]
    assert {r.source_id for r in out["aliases"]} == set("abcefg")
    assert [(r.kind, r["values"]) for r in out["conflicts"]] == [("name_conflict", ["Алгебра", "алгебра"])]
    assert tuple(out["verification"][0]) == (True, False, True)


def test_words_in_cells_and_lines(spark):
    words = spark.createDataFrame([(1, "a", 0.0, 4.0, 0.0, 2.0), (1, "b", 5.0, 9.0, 0.4, 2.4), (1, "c", 60.0, 64.0, 0.0, 2.0), (2, "d", 0.0, 4.0, 0.0, 2.0), (1, "e", 3.0, 8.0, 9.0, 11.0)], "page int, text string, x0 double, x1 double, top double, bottom double")
    cells = spark.createDataFrame([(1, "L", 0.0, 5.0, 0.0, 3.0), (1, "R", 5.5, 70.0, 0.0, 3.0), (1, "T", 7.4, 8.0, 0.0, 0.9)], "page int, cell string, left double, right double, upper double, lower double")
    got = {(r.text, r.cell) for r in ordered.words_in_cells(words, cells, ["page"]).collect()}
    expected = {(w.text, c.cell) for w in words.collect() for c in cells.collect() if w.page == c.page
                and c.left - 0.6 <= (w.x0 + w.x1) / 2 <= c.right + 0.6 and c.upper - 0.6 <= (w.top + w.bottom) / 2 <= c.lower + 0.6}
    assert got == expected
    assert ("b", "T") in got and ("b", "R") in got
    lines = {r.page: r for r in ordered.line_envelopes(words.where("text <> 'e'"), ["page"]).collect()}
    assert (lines[1].x0, lines[1].x1, lines[1].top, lines[1].bottom, lines[1].text, lines[1].n_words) == (0.0, 64.0, 0.0, 2.4, "a b c", 3)


def test_section_path_and_state(spark):
    rng = random.Random(4)
    rows = [(d, i, rng.choice(["A", "B", "C", "", None]), rng.random() < 0.5, rng.choice([None, None, "own"])) for d in range(5) for i in range(40)]
    df = spark.createDataFrame(rows, "d int, i int, name string, g boolean, own string")
    got = {(r.d, r.i): r for r in ordered.section_path(df, ["d"], ["i"], F.col("name"), F.col("g")).collect()}
    state = {(r.d, r.i): r.state for r in ordered.carry_forward(df, ["d"], ["i"], F.col("own"), F.when(F.col("g"), F.col("name")), "unknown").collect()}
    for d in range(5):
        path, carried, last = [], None, None
        for _, i, name, g, own in (r for r in rows if r[0] == d):
            assert state[d, i] == (own if own is not None else carried if carried is not None else "unknown")
            if g and name and name != last:
                path.append(name)
            if g and name:
                last = name
            if g and name is not None:
                carried = name
            assert got[d, i].section_path == " > ".join(path)


def test_cluster_lines(spark):
    rng = random.Random(1)
    lists = [sorted(round(rng.random() * 20, 2) for _ in range(rng.randrange(0, 12))) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, v array<double>")
    got = {r.i: r.c for r in df.select("i", ordered.cluster_lines(F.col("v")).alias("c")).collect()}
    for i, values in enumerate(lists):
        lines, first, expected = -1, None, []
        for x in values:
            if first is None or abs(x - first) > 1.6:
                lines, first = lines + 1, x
            expected.append(lines)
        assert got[i] == expected


def test_line_numbers(spark):
    rng = random.Random(2)
    rows = [(g, round(rng.random() * 30, 2)) for g in (1, 2, None) for _ in range(60)] + [(5, None), (6, 1.0)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    got = {}
    for r in ordered.line_numbers(df, "g", "v").collect():
        got.setdefault(r.g, []).append((r.v, r.line))
    arrays = df.where("v is not null").groupBy("g").agg(F.array_sort(F.collect_list("v")).alias("v")).select("g", "v", ordered.cluster_lines(F.col("v")).alias("c")).collect()
    assert {g: sorted(x) for g, x in got.items()} == {r.g: list(zip(r.v, r.c, strict=True)) for r in arrays}


def test_bands(spark):
    points = spark.createDataFrame([(1, 4.9), (2, 5.1), (3, 10.15), (4, 10.2), (5, None)], "i int, x double")
    bands = spark.createDataFrame([(0, 0.0, 5.0), (1, 5.0, 10.0)], "band int, left double, right double")
    expected = {(1, 0), (1, 1), (2, 0), (2, 1), (3, 1)}
    assert {(r.i, r.band) for r in ordered.in_bands(points, "x", bands).collect()} == expected
    assert {(r.i, r.band) for r in ordered.range_join(points, "x", bands, 3.0, 0.15).collect()} == expected
    near = points.select("i", ordered.nearest_band(F.col("x"), [(7, 0.0, 5.0), (8, 5.2, 9.0)]).alias("b")).collect()
    assert {r.i: r.b for r in near if r.i != 5} == {1: 7, 2: 7, 3: 8, 4: 8}
    cells = spark.range(1).select(ordered.equal_bands(F.lit(0.0), F.lit(10.0), F.lit(2)).alias("c")).first().c
    assert [(c.band, c.part) for c in cells] == [(b, p) for b in (1, 2) for p in range(5)]
    assert (cells[0].left, cells[-1].right) == (0.0, 10.0)
    assert spark.range(1).select(ordered.equal_bands(F.lit(0.0), F.lit(1.0), F.lit(0)).alias("c")).first().c == []


def test_relations(spark):
    rows = [(1, 2, "b"), (1, 1, "a"), (2, 1, "c"), (None, 1, "d"), (None, 2, "e")]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    assert {(r.k, r.v) for r in relations.first_wins(df, ["k"], ["o"]).collect()} == {(1, "a"), (2, "c"), (None, "d")}
    assert {(r.k, r.v) for r in relations.last_wins(df, ["k"], ["o"]).collect()} == {(1, "b"), (2, "c"), (None, "e")}
    left, right = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert {tuple(r) for r in relations.multiset_difference(left, right).collect()} == {(1, "left", 1), (2, "left", 1), (None, "left", 1), (3, "right", 1)}
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("p", "q"), ("q", "p"), ("s", "s")], "alias string, target string")
    assert {tuple(r) for r in relations.alias_closure(chain).collect()} == {("a", "d"), ("b", "d"), ("c", "d"), ("x", "y"), ("p", "p"), ("q", "q"), ("s", "s")}
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (2, 3)], "parent int, child int")
    assert {tuple(r) for r in relations.tree(edges, spark.createDataFrame([(0,)], "node int")).collect()} == {(0, 0), (1, 1), (2, 2), (3, 3)}
    objects = spark.createDataFrame([("k", 1, "x", None), ("k", 2, "", "z")], "k string, o int, a string, b string")
    assert tuple(relations.merge_objects(objects, ["k"], ["a", "b"], "o").first()) == ("k", "x", "z")


def test_integrity(spark):
    df = spark.createDataFrame([("a",), ("a",), ("",), (None,), ("b",)], "id string")
    assert [tuple(r) for r in integrity.duplicate_ids(df, "id").collect()] == [("a", 2)]
    counts = integrity.dataset_counts({"t": (df, "id")})
    assert counts.first().n_missing == 2
    empty = spark.createDataFrame([], "x boolean")
    assert empty.agg(integrity.all_true(F.col("x")).alias("a")).first().a is True
    checks = spark.createDataFrame([("c", True), ("d", False)], "name string, passed boolean")
    report = integrity.gate(counts, checks, ["u"])
    assert report["errors"] == ["check d failed", "t: duplicate ids", "t: missing ids", "u: no rows"]
    declared = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, None), (4, 1.0)], "id int, total double")
    detail = spark.createDataFrame([(1, 4.0), (1, 6.005), (2, 1.0)], "ref int, x double")
    got = {r.id: r["class"] for r in integrity.reconcile(declared, "id", detail, "ref", {"t": ("total", F.col("x"))}, F.lit(True)).collect()}
    assert got == {1: "exact", 2: "mismatch", 3: "exact", 4: "unallocated"}


def test_paging(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x", f"Name{i}") for i in range(10)], "id int, c string, name string")
    got = paging.page(df, ["id"], 3, 4).collect()
    assert [(r.id, r.total, r.has_more) for r in got] == [(i, 10, True) for i in (3, 4, 5, 6)]
    assert paging.equal_to(df, {"c": ""}).count() == 10
    assert paging.search(df, "NAME3").count() == 1
    assert paging.search(df, '"ID":').count() == 10  # names of columns are searched, too
    for bad in ((-1, 5), (0, 0), (0, 501)):
        with pytest.raises(ValueError):
            paging.page(df, ["id"], *bad)
    with pytest.raises(ValueError):
        paging.equal_to(df, {"name": "x"}, ["id"])


def test_projections(spark):
    df = spark.createDataFrame([("0", None, "a;\n ; b \n"), ("", "k", None)], "a string, b string, t string")
    got = df.select(project.field_meta(a=F.col("a"), b=F.col("b")).alias("m"), project.lines(F.col("t")).alias("l"), *[c.alias(n) for c, n in zip(project.relation_id(F.col("b"), "u", "x", False), ("i", "un"), strict=True)]).collect()
    assert [got[0].m["a"].status, got[0].m["b"].status, got[1].m["a"].status] == ["published", "not_published", "not_published"]
    assert got[0].l == ["a", "b"]
    assert [(r.i, r.un) for r in got] == [("", None), ("", "k")]
    ext = df.select(project.extensions("u", F.create_map(F.lit("r"), F.col("b")), F.array("a"), F.create_map().cast("map<string,string>")).alias("e")).collect()
    assert ext[1].e["u"]["r"] == "k"
