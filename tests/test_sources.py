"""XML layouts, office documents, manifests with statuses, catalogues, paged lists, runs and resumable work."""

import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from lectern.operators import ordered
from lectern.plans import resumable, runs
from lectern.sources import catalog, documents, layout
from lectern.sources.office import document_parts, read_docx

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def test_layout(spark):
    page = '<page width="10" height="20"><line><word xMin="1" yMin="2" xMax="3" yMax="4"> a</word><word yMin="1"> </word></line><block><line><word>b</word></line><line><word/></line></block><flow><block><line><word yMin="5.5" yMax="7">c&lt;d</word></line></block></flow></page>'
    cases = {
        "plain": f"<doc>{page}<page/></doc>", "spaces": f'<p:doc xmlns:p="urn:x">{page.replace("<word", "<p:word").replace("</word", "</p:word")}</p:doc>', "body": f"<html><head/><body>{page}</body></html>",
        "none": "<doc/>", "null": None, "empty": "", "text": "no xml", "cut": f"<doc>{page}", "number": '<doc><page width="wide"/></doc>',
    }
    got = {r.k: r for r in layout.read_layout(spark.createDataFrame(list(cases.items()), "k string, xml string").withColumn("page", F.lit(1)), "xml").collect()}
    assert {k for k, r in got.items() if r.status == "error"} == {"null", "empty", "text", "cut", "number"}
    for k in ("plain", "spaces", "body"):
        first = got[k].pages[0]
        assert [(w.id, w.text, w.x0, w.top, w.bottom) for w in first.words] == [("word-1-0", " a", 1.0, 2.0, 4.0), ("word-1-1", "b", 0.0, 0.0, 0.0), ("word-1-2", "c<d", 0.0, 5.5, 7.0)]
        assert [(x.line_index, x.text, x.top, x.bottom, x.word_ids) for x in first.lines] == [(0, " a", 2.0, 4.0, ["word-1-0"]), (1, "b", 0.0, 0.0, ["word-1-1"]), (2, "c<d", 5.5, 7.0, ["word-1-2"])]
    assert [(p.page_number, p.width, len(p.words)) for p in got["plain"].pages] == [(1, 10.0, 3), (2, 0.0, 0)]
    assert got["none"].pages == []


def cell(*paragraphs, span=1, merge=None):
    more = (f'<w:gridSpan w:val="{span}"/>' if span > 1 else "") + ("" if merge is None else f'<w:vMerge w:val="{merge}"/>' if merge else "<w:vMerge/>")
    return f"<w:tc><w:tcPr>{more}</w:tcPr>" + "".join(f"<w:p><w:r><w:t>{x}</w:t></w:r></w:p>" for x in paragraphs) + "</w:tc>"


def docx(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


NESTED = f"<w:tc><w:tbl><w:tr>{cell('inner')}</w:tr></w:tbl><w:p><w:r><w:t>outer</w:t></w:r></w:p></w:tc>"
BODY = (
    "<w:p><w:r><w:t>one</w:t><w:tab/><w:t>two</w:t><w:br/></w:r><w:hyperlink><w:r><w:t>link</w:t></w:r></w:hyperlink></w:p>"
    f"<w:tbl><w:tr>{cell('a', 'b', span=2)}{cell('c', merge='restart')}</w:tr><w:tr>{cell('d')}{cell('e')}{cell('', merge='')}</w:tr><w:tr>{cell('f', span=2, merge='')}{cell('', merge='')}</w:tr></w:tbl>"
    f"<w:p/><w:tbl><w:tr>{NESTED}</w:tr></w:tbl>"
)


def test_docx_grid(spark, tmp_path):
    parts = document_parts(docx(BODY))
    assert [(p[0], p[2], p[5]) for p in parts if p[1] == "paragraph"] == [(0, 0, "one\ttwo\nlink"), (2, 1, "")]
    grid = {(p[2], p[3], p[4]): (p[5], p[6]) for p in parts if p[1] == "cell"}
    assert grid[0, 0, 0] == ("a\nb", False)
    assert grid[0, 0, 1] == ("a\nb", True)
    assert grid[0, 0, 2] == ("c", False)
    assert grid[0, 1, 2] == grid[0, 2, 2] == ("c", True)
    assert grid[0, 2, 0] == ("d", True)  # a merge without a start goes on with what is above
    assert grid[1, 0, 0] == ("outer", False)
    assert len(grid) == 10
    (tmp_path / "a.docx").write_bytes(docx(BODY))
    assert read_docx(spark, str(tmp_path)).where("kind = 'cell'").count() == 10
    assert document_parts(docx("")) == []


def test_statuses_of_a_manifest(spark, tmp_path):
    (tmp_path / "plans").mkdir()
    held = {"a.docx": docx(BODY), "b.docx": docx("<w:p/>"), "c.docx": docx(BODY)[:50], "d.docx": b"<html>", "e.pdf": b"%PDF-1.5", "f.zip": docx(BODY), "g.docx": b"", "not asked for.docx": b"PK\x03\x04"}
    for name, content in held.items():
        (tmp_path / "plans" / name).write_bytes(content)
    rows = [(n, f"plans\\{n}", 1) for n in held if n[0] != "n"] + [("again", "plans/a.docx", 2), ("absent", "plans/zz.docx", 3), ("no path", None, 4)]
    manifest = spark.createDataFrame(rows, "document_id string, local_path string, _x int")
    got = {r.document_id: r for r in documents.extract(manifest, documents.listed(spark, str(tmp_path))).collect()}
    assert len(got) == len(rows)
    assert {k: r.status for k, r in got.items()} == {"a.docx": "ok", "again": "ok", "b.docx": "ok_no_tables", "c.docx": "error", "d.docx": "invalid_source", "e.pdf": "error", "f.zip": "invalid_source", "g.docx": "missing", "absent": "missing", "no path": "missing"}
    assert (got["a.docx"].table_count, got["a.docx"].row_count, got["a.docx"].cell_count, got["a.docx"].paragraph_count) == (2, 4, 10, 2)
    assert "BadZipFile" in got["c.docx"].error
    assert "no reader" in got["e.pdf"].error
    assert got["a.docx"]["_x"] == 1
    with_pdf = {r.document_id: r.status for r in documents.extract(manifest, documents.listed(spark, str(tmp_path)), {"pdf": lambda c: ([], [])}).collect()}
    assert (with_pdf["e.pdf"], with_pdf["a.docx"]) == ("ok_no_tables", "error")


def test_catalogue_along_its_chain(spark):
    card = lambda href, category="", title="": f'<a class="x e-card y" href="{href}"><i class="e-card__category">{category}</i><div class="e-card__title-inner">{title}</div></a>'
    pages = [
        ("http://h/1", '<link rel="prev next" href="2">' + card("/p/a", "01.02.03 Maths", "Algebra") + card("/p/b", "no code", "") + card("", "01.02.03 x", "no address")),
        ("http://h/2", '<link rel="nextish" href="9"><link rel="next" href="/3">' + card("/p/a#again", "", "later") + card("/p/c", "01.02.03 Only   field", "")),
        ("http://h/3", '<link rel="next" href="http://h/2">' + card("/p/d", "", "D")),  # leads back
        ("http://h/4", card("/p/e", "", "unreached")), ("http://h/5", '<link rel="next" href="http://h/gone">' + card("/p/f", "", "F")), (None, card("/p/g", "", "G")), ("http://h/6", None),
    ]
    read = catalog.read_cards(spark.createDataFrame([(u, h, 1) for u, h in pages], "address string, body string, next int"), "address", "body")
    starts = spark.createDataFrame([(1, "http://h/1"), (2, "http://h/5"), (3, "http://h/absent"), (4, "http://h/2")], "catalog int, url string")
    chain = {(r.catalog, r.url): r.place for r in catalog.page_chain(read, starts).collect()}
    assert chain == {(1, "http://h/1"): 0, (1, "http://h/2"): 1, (1, "http://h/3"): 2, (2, "http://h/5"): 0, (4, "http://h/2"): 0, (4, "http://h/3"): 1}
    got = {(r.catalog, r.source_key): r for r in catalog.catalog_cards(read, starts).collect()}
    first = got[1, "http://h/p/a"]
    assert (first.name, first.code, first.direction, first.direction_name, first.page_number) == ("Algebra", "01.02.03", "01.02.03", "Maths", 1)
    assert (got[1, "http://h/p/c"].name, got[1, "http://h/p/c"].direction_name) == ("Only field", "Only field")
    assert got[4, "http://h/p/a"].name == "later"
    assert {k for c, k in got if c == 1} == {"http://h/p/a", "http://h/p/c", "http://h/p/d"}


def test_long_chains(spark):
    pages = spark.range(1000).select(F.concat(F.lit("u"), "id").alias("url"), F.concat(F.lit("u"), F.col("id") + 1).alias("next"))
    got = catalog.page_chain(pages, spark.createDataFrame([(0, "u3")], "catalog int, url string"))
    assert got.where("concat('u', place + 3) = url").count() == got.count() == 997


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 40, 95])
@pytest.mark.parametrize("told", [None, "true", 35, 1000])
def test_lists_end_where_they_end(n, told):
    calls = []

    def fetch(offset, limit):
        calls.append(offset)
        rows = [(i,) for i in range(offset, min(offset + limit, n))]
        return rows if told is None else (rows, n if told == "true" else told)

    def in_order():
        out, offset = [], 0
        while True:
            rows = [i for (i,) in (lambda g: g[0] if isinstance(g, tuple) else g)(fetch(offset, 10))]
            out += rows
            total = {None: None, "true": n}.get(told, told)
            if len(rows) < 10 or (total is not None and offset + len(rows) >= total):
                return out
            offset += 10

    expected = in_order()
    calls.clear()
    reader = catalog._OffsetReader(fetch, 10, 3, None)
    parts = reader.partitions()
    assert len(calls) <= 12
    assert [i for p in parts for (i,) in reader.read(p)] == expected


def test_run_manifest(spark, tmp_path):
    root = str(tmp_path / "store")
    (tmp_path / "store").mkdir()
    (tmp_path / "store" / "raw.txt").write_bytes(b"abc")
    with pytest.raises(ZeroDivisionError), runs.Run(spark, root, "r1", "p") as run:
        one = run.write("one", spark.range(10), "one", ["raw.txt", "absent", "https://example.com/x"], {"top": F.max("id")})
        run.write("none", one.where("id < 0"), "none", ["one"], {"top": F.max("id")})
        1 / 0
    assert (runs.latest(spark, root)["status"], runs.latest(spark, root)["manifest"]) == ("failed", "r1.json")
    got = {r.name: r for r in runs.stages(spark, f"{root}/runs/r1.json").collect()}
    assert (got["one"].rows, got["one"].metrics) == (10, {"top": "9"})
    assert (got["none"].rows, got["none"].metrics) == (0, {"top": None})
    raw, absent, web = got["one"].inputs
    assert (raw.size_bytes, raw.sha256) == (3, "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad")
    assert (absent.available, web.kind) == (False, "external")
    assert got["one"].outputs[0].file_count > 0
    with runs.Run(spark, root, "r2", "p", parent="r1"):
        pass
    assert json.loads((tmp_path / "store" / "runs" / "r2.json").read_text())["status"] == "succeeded"


def test_resumed_after_a_crash(spark, tmp_path):
    root, seen = str(tmp_path), []
    inputs = spark.createDataFrame([(i, f"f{i}", i) for i in range(40)] + [(7, "later", 99)], "k int, f string, v int")

    def work(part, n, fail=False):
        seen.append((n, part.count()))
        if fail and len(seen) == 3:
            raise RuntimeError("crash")
        return part.select("k", (F.col("v") * 2).alias("w"), F.lit(n).alias("n"))

    go = lambda n, fail=False, rows=inputs: resumable.run(spark, rows, root, n, lambda p: work(p, n, fail), "k", "f", batches=4, deal=F.col("k"))
    assert resumable.results(spark, inputs, root, "k", "f") is None
    with pytest.raises(RuntimeError):
        go(1, fail=True)
    assert resumable.committed(spark, root) == ["00000001-0", "00000001-1"]
    assert go(2) == 20
    assert go(3) == 0
    read = lambda rows=inputs: {r.k: (r.w, r.n) for r in resumable.results(spark, rows, root, "k", "f").collect()}
    assert read() == {i: (2 * i, 1 if i % 4 < 2 else 2) for i in range(40)}
    for part in (tmp_path / "ledger" / "00000002-2").iterdir():
        if part.name == "_SUCCESS":
            part.unlink()  # the ledger's write was cut off
    (tmp_path / "results" / "00000001-0" / "_SUCCESS").unlink()
    assert go(4) == 20
    changed = inputs.withColumn("f", F.when(F.col("k") == 1, "new").otherwise(F.col("f"))).withColumn("v", F.when(F.col("k") == 1, 50).otherwise(F.col("v"))).where("k < 5")
    assert go(5, rows=changed) == 1
    assert read(changed) == {0: (0, 4), 1: (100, 5), 2: (4, 4), 3: (6, 2), 4: (8, 4)}
    keep = resumable.committed(spark, root)
    resumable.forget(spark, root, keep)
    assert {p.name for p in (tmp_path / "results").iterdir()} == set(keep)
    assert read(changed)[1] == (100, 5)
    with pytest.raises(ValueError, match="without k"):
        go(6, rows=spark.createDataFrame([(None, "f", 1)], "k int, f string, v int"))


def test_spans_of_any_width(spark):
    rng = random.Random(5)
    span = lambda i: (i, i % 3 and 1, a := rng.uniform(-50, 50), a + rng.choice([0, 0.05, 0.11, 1, 3, 64, 64.0001, 1000]))
    ours, others = [span(i) for i in range(300)], [span(i) for i in range(200)]
    ours += [(300, 0, None, 3.0), (301, 0, 5.0, 1.0), (302, None, 0.0, 10.0), (303, 0, -64.0, 64.0), (304, 0, 0.0, 64.0)]
    others += [(200, 0, -64.0, 64.0), (201, 0, 64.0, 65.0), (202, None, 0.0, 10.0)]
    left = spark.createDataFrame(ours, "i int, g int, left double, right double")
    right = spark.createDataFrame(others, "j int, g int, other_left double, other_right double")
    for least in (0, 0.1):
        met = ordered.overlapping(left, right, ["g"], least).select("i", "j").collect()
        expected = {(i, j) for i, g, a, b in ours for j, h, c, d in others if None not in (g, a, h) and g == h and min(b, d) - max(a, c) > least and b - a > least and d - c > least}
        assert len(met) == len(expected)
        assert {tuple(r) for r in met} == expected
    with pytest.raises(ValueError, match="least"):
        ordered.overlapping(left, right, ["g"], -1)
    points = spark.createDataFrame([(i, rng.uniform(-60, 60)) for i in range(200)] + [(200, None), (201, 64.15)], "p int, x double")
    got = ordered.in_bands(points, "x", left.drop("g"), slack=0.15).select("p", "i").collect()
    inside = [(p, i) for p, x in points.collect() if x is not None for i, _, a, b in ours if a is not None and a - 0.15 <= x <= b + 0.15]
    assert sorted(map(tuple, got)) == sorted(inside)


def test_narrow_spans_do_not_meet_in_wide_cells(spark):
    """Candidates of 2,000 short spans side by side under one long span stay in proportion to the pairs."""
    rows = [(i, 0, float(i), i + 0.9) for i in range(2000)] + [(2000, 0, 0.0, 2000.0)]
    left = spark.createDataFrame(rows, "i int, g int, left double, right double")
    right = spark.createDataFrame(rows, "j int, g int, other_left double, other_right double")
    met = ordered.overlapping(left, right, ["g"])
    assert met.count() == 2000 + 2 * 2000 + 1
    found = met._jdf.queryExecution().executedPlan()
    assert "CartesianProduct" not in found.toString()
    assert "NestedLoop" not in found.toString()
