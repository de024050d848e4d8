"""Plans and helpers whose cost must grow no faster than their tables."""

import pyarrow as pa
from pyspark.sql import functions as F

from lectern import domain_queries, queries, source_queries
from lectern.functions import ids, text
from lectern.functions.lineage import written
from lectern.operators import ordered
from lectern.plans import canonical, curriculum, extraction, resumable
from lectern.sources import layout, office

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_with_cells_need_no_join_and_no_python_per_cell(spark):
    rows = [[("h", 0.0, 5.0, []), None, ("i", 5.0, 10.0, [])], None, [("x", 0.0, 5.0, [])], []]
    docs = spark.createDataFrame([("Ж 1", "ok", [], [(0, 1, "s", 4, 3, 0.0, 10.0, rows)]), ("e", "missing", None, None)], extraction.DOCUMENTS)
    for scope in ("plan", "Straße "):
        flat = extraction.flatten(docs, scope)
        own = extraction.rows_with_cells(docs, scope)
        told = lambda df: sorted((r.row_id, r.row_index, r.cell_count, tuple(r.cell_ids)) for r in df.collect())
        assert told(own) == told(extraction.row_cells(flat)) and [r[2] for r in sorted(told(own), key=lambda r: r[1])] == [2, 1, 0]
        assert "Join" not in plan(own)
    ids = {r.table_id: r.cell_id for r in flat["cells"].where("row_index = 2").collect()}
    table_id, cell_id = ids.popitem()
    one = spark.createDataFrame([(table_id,)], "t string").select(extraction.legacy_id("Straße ", "cell", extraction.F.col("t"), extraction.F.lit(2), extraction.F.lit(0)).alias("id"))
    assert one.first().id == cell_id


def test_documents_gather_bare_keys_without_sorting(spark):
    found = domain_queries._documents(spark, SMALL)
    assert "Window" not in plan(found)
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_layouts_are_parsed_once_and_words_counted_once(spark):
    found = source_queries.layout_lines(spark, SMALL)
    assert plan(found).count("from_xml") == 1 and "slice(" not in plan(found)
    page = lambda n: "<doc><page>" + "".join(f"<line><word>a{i}</word>{'<word>b</word>' * (i % 3)}</line>" for i in range(n)) + "</page></doc>"
    docs = spark.createDataFrame([(1, page(40)), (2, "<doc/>"), (3, "<doc><page/></doc>")], "k long, x string")
    lines = layout.layout_lines(layout.read_layout(docs, "x"), "k").orderBy("line_index").collect()
    assert [w for r in lines for w in r.word_ids] == [f"word-1-{i}" for i in range(sum(1 + i % 3 for i in range(40)))]
    assert [len(r.word_ids) for r in lines] == [1 + i % 3 for i in range(40)]


def test_bands_are_dealt_out(spark):
    found = queries.equal_bands(spark, SMALL)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and plan(found).count("sequence(") == 1


def test_documents_are_made_one_at_a_time():
    part = pa.list_(pa.struct([("k", pa.int64()), ("s", pa.int32())]))
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b"]), pa.array([7, 8]), pa.array(["x", "y"]), pa.array([[{"k": 1, "s": 2}], []], part)], ["p", "k", "n", "l"])
    made = list(source_queries._docx(iter([batch])))
    assert [(b.num_rows, b.column(0)[0].as_py()) for b in made] == [(1, "a"), (1, "b")]
    assert [c[3] for c in office.document_cells(made[0].column(1)[0].as_py())][3:] == ["1", "x2", "size"]


def test_checks_say_the_same_of_stored_names(spark):
    docs = domain_queries._documents(spark, SMALL)
    failed = extraction.quality(extraction.flatten(docs), 3)["failed"]
    names = docs.where("size(tables) > 0").selectExpr("document_id", "explode(tables[0].rows) as r").selectExpr("concat_ws(':', document_id, '1', r[1].word_ids[0]) as n")
    assert failed["unknown_words"] == {"n": names.distinct().count(), "examples": [r.n for r in names.distinct().orderBy("n").limit(3).collect()]}


def test_batches_are_named_without_a_pattern_per_row(spark, tmp_path):
    inputs = spark.createDataFrame([(k, str(k)) for k in range(20)], "k long, f string")
    assert resumable.run(spark, inputs, str(tmp_path), 1, lambda p: p.select("k"), "k", "f", batches=4) == 20
    found = resumable.results(spark, inputs, str(tmp_path), "k", "f")
    assert sorted(r.k for r in found.collect()) == list(range(20)) and "regexp" not in plan(found)


def test_keys_send_one_column_to_python_each(spark):
    rows = [("HTTP://Ex.com:80/A/#x",), ("https://ex.com//",), ("https://ex.com:8443/a/?b=2&a=1",), (" http://ex.com/Ж",), ("a  B",), ("A/b",), ("é",), ("x://Y z",), ("",), (None,)]
    df = spark.createDataFrame(rows, "c string")
    found = df.select("c", ids.stable_part(F.col("c")).alias("k"))
    told = lambda x: "" if x is None else text._canonical_url(x) if x.strip().lower().startswith("http") else text._normalize_key(x)
    assert all(r.k == told(r.c) for r in found.collect())
    assert plan(found).count("ArrowEvalPython [_stable_other(") == 1 and plan(found).count("pythonUDF1") == 0
    assert [r[0] for r in df.select(text.canonical_url("c")).collect()] == [text._canonical_url(r[0]) for r in rows]
    plain = df.where("c like '%Ex.com%' or c like '%//'").select("c", F.when(text.is_plain_url(F.col("c")), text.plain_url(F.col("c"))).alias("k"))
    assert [r.k for r in plain.collect()] == ["http://ex.com/A", "https://ex.com"]


def test_aliases_are_made_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(canonical, "_aliases", lambda *sides: made.append(sides) or sides[0])
    rows = spark.createDataFrame([("t", "a", "x"), ("t", "a", "x"), ("t", "b", "y")], "entity_type string, legacy_id string, canonical_id string")
    found = canonical.checked_aliases(rows, rows)
    assert sorted(map(tuple, found.collect())) == [("t", "a", "x"), ("t", "b", "y")] and len(made) == 1
    assert "Aggregate" not in plan(found)


def test_canonical_addresses_are_read_once_in_joins(spark):
    keyed = lambda name: spark.range(3).select(text.canonical_url(F.concat(F.lit("http://h/"), "id")).alias("k"), F.col("id").alias(name))
    assert plan(keyed("a").join(keyed("b"), "k")).count("ArrowEvalPython") == 2


def test_crowded_cells_are_dealt_to_several_tasks(spark):
    n, crowded = 1200, 100
    at = lambda i: (i * 37 % n) / 10
    spans = [(i, i % 3 and 1, at(i), at(i) + (90.0 if i % 40 == 0 else 0.15)) for i in range(n)] + [(n, 0, 5.0, None), (n + 1, 0, 5.0, 5.05), (None, 0, 5.0, 9.0), (7, 1, 5.0, 9.0), (8, 1, 5.0, 9.0)]
    df = spark.createDataFrame(spans, "i long, g int, left double, right double").repartition(4)
    met = ordered.own_overlaps(df, "i", ["g"], crowded=crowded)
    whole = [s for s in spans if s[0] is not None and s[3] is not None]
    expected = sorted((a[1], a[0], b[0]) for a in whole for b in whole if a[1] == b[1] and a[0] < b[0] and min(a[3], b[3]) - max(a[2], b[2]) > 0.1)
    assert sorted((r.g, r.i, r.other) for r in met.collect()) == expected
    bands = df.where("i % 40 = 0").select("i", "left", "right")
    points = df.select(F.col("i").alias("p"), F.col("left").alias("x"))
    found = ordered.in_bands(points, "x", bands, crowded=crowded)
    wide = [s for s in whole if s[0] % 40 == 0]
    assert sorted((r.i, r.p or -1) for r in found.collect()) == sorted((b[0], p[0] or -1) for b in wide for p in spans if b[2] - 0.15 <= p[2] <= b[3] + 0.15)
    for pairs, most in ((met, len(expected)), (found, found.count())):
        per_task = [r["n"] for r in pairs.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(per_task) == 4 and max(per_task) < 0.6 * most
    assert sorted(tuple(r) for r in met.collect()) == sorted(tuple(r) for r in ordered.own_overlaps(df, "i", ["g"]).collect())


def test_words_and_headings_of_curricula_are_read_once(spark):
    tables, cells, words = source_queries._tables(spark, SMALL)
    schemas = curriculum.discover_schemas(tables, cells)
    assert "lower(" not in plan(schemas)
    schemas = schemas.localCheckpoint()
    texts = curriculum.band_texts(tables, cells, words, schemas)
    assert plan(texts).count("explode(word_ids") == 0 and plan(texts).count("Window") == 0
    told = curriculum.band_sources(tables, cells, words, schemas)
    assert "explode(" not in plan(told) and "Window" not in plan(told)


def test_texts_of_loads_are_cut_once(spark):
    tables, cells, words = source_queries._tables(spark, SMALL)
    found = curriculum.disciplines(curriculum.semantic_rows(curriculum.band_texts(tables, cells, words, curriculum.discover_schemas(tables, cells))))
    patterns = [plan(df).count("regexp_replace(") for df in (found, curriculum.semester_loads(found))]
    assert patterns[1] - patterns[0] < 25


def test_large_tables_of_rows_that_are_alike_are_not_broadcast(spark):
    """Millions of rows that are alike take few bytes as a file, so Spark would send them through the driver."""
    alike = spark.range(30_000).select((F.col("id") % 7).alias("k"), F.lit("x" * 50).alias("text"))
    large, few = written(alike), written(alike.limit(100))
    keys = spark.range(10_000).select((F.col("id") + 1_000_000).alias("k"))
    joins = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for met in (keys.join(large, "k", "left"), keys.join(large.where("k > 2").groupBy("k").count(), "k"), large.join(keys, "k", "left_anti")):
        assert "BroadcastHashJoin" not in joins(met)
    assert large.join(keys, "k", "left_anti").count() == 30_000
    assert "BroadcastHashJoin" in joins(spark.range(10).withColumnRenamed("id", "k").join(few, "k"))


def test_bands_are_no_table_of_rows_times_bands(spark):
    tables, cells, words = source_queries._tables(spark, SMALL)
    schemas = curriculum.discover_schemas(tables, cells).localCheckpoint()
    rows = curriculum.placed(tables, cells, words, schemas)
    assert rows.count() == cells.where("row_index > 3").select("table_id", "row_index").distinct().count()
    for made in (curriculum.band_texts(tables, cells, words, schemas, rows), curriculum.band_sources(tables, cells, words, schemas, parts=rows)):
        assert "Join" not in plan(made) and "Aggregate" not in plan(made)


def test_schemas_are_written_before_they_are_joined(spark, monkeypatch):
    """As a checkpoint they would be broadcast at any number of documents."""
    seen = []
    monkeypatch.setattr(source_queries, "written", lambda df: seen.append(df.columns) or written(df))
    source_queries.curriculum_sources(spark, SMALL)
    assert any("spans" in columns for columns in seen)
