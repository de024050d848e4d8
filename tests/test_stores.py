"""Headings and provenance of curriculum tables, migrations, views, white space, stored aliases."""

import pytest
from pyspark.sql import functions as F

from lectern.functions import ids, numbers, text, tokens
from lectern.operators import integrity, ordered
from lectern.plans import contracts, curriculum, extraction, migration, snapshots
from lectern.sources import files


def test_gaps_and_steps_back(spark):
    rows = spark.createDataFrame([("a", 0, 1), ("a", 1, 4), ("a", 2, 4), ("a", 3, 3), ("a", 4, 9), ("b", 0, 1), ("b", 1, 2), ("c", 0, 3), ("d", 0, None), ("e", 0, 0), (None, 0, 2)], "g string, o int, n int")
    assert sorted(map(tuple, ordered.gaps(rows, ["g"], "n").collect()), key=str) == sorted([("a", 2, 2), ("a", 5, 8), ("c", 1, 2), (None, 1, 1)], key=str)
    assert {r.g: (r.repeated, r.unordered) for r in ordered.steps_back(rows, ["g"], ["o"], "n").collect()} == {"a": ([4], True), "b": ([], False), "c": ([], False), "e": ([], False), None: ([], False)}


def test_warnings_of_a_heading(spark):
    tables = spark.createDataFrame([(f"t{i}", f"d{i}", 1, 0, "curriculum", 0.0, 100.0) for i in range(3)], "table_id string, document_id string, page_number int, ordinal int, section string, x0 double, x1 double")
    head = {0: ["3 - 15 недель", "1 - 17 недель 1 - 9 недель"], 1: ["6 - 10 недель"], 2: ["nothing"]}
    cells = [(f"t{i}", 0, c, f"c{i}-{c}", x, 50.0 + 10 * c, 55.0 + 10 * c, []) for i, texts in head.items() for c, x in enumerate(texts)]
    cells = spark.createDataFrame(cells, "table_id string, row_index int, column_index int, cell_id string, text string, x0 double, x1 double, word_ids array<string>")
    got = {r.document_id: r for r in curriculum.discover_schemas(tables, cells).collect()}
    assert set(got) == {"d0", "d1"}
    assert got["d0"].warnings[:3] == ["missing_semesters:2", "repeated_semesters:1", "unordered_semesters"]
    assert got["d0"].weeks == {3: 15, 1: 9}
    assert got["d1"].warnings[0] == "missing_semesters:1-5"
    assert got["d1"].warnings[-1].startswith("missing_fields:code,name")


def test_migration_twice(spark, tmp_path):
    root = str(tmp_path)
    raw = spark.createDataFrame([("k1", "one"), ("k2", "two")], "k string, name string")
    build = lambda prefix: lambda r: {"things": r.select(F.concat(F.lit(prefix), "k").alias("id"), "k", "name")}
    first = migration.migrate(spark, root, "r1", raw, build("a-"), {"things": "k"})
    assert (first["changed"], first["aliases"]) == (True, 0)
    assert not migration.migrate(spark, root, "r2", raw, build("a-"), {"things": "k"})["changed"]
    explicit = spark.createDataFrame([("things", "z", "b-k1"), ("things", "b-k2", "b-k2"), ("things", "", "b-k1")], "entity_type string, legacy_id string, canonical_id string")
    second = migration.migrate(spark, root, "r2", raw, build("b-"), {"things": "k"}, explicit)
    assert (second["changed"], second["aliases"]) == (True, 3)
    again = migration.migrate(spark, root, "r3", raw, build("b-"), {"things": "k"}, explicit)
    assert (again["changed"], again["snapshot"]) == (False, second["snapshot"])
    aliases = spark.read.parquet(f"{second['snapshot']}/aliases").collect()
    assert {(r.legacy_id, r.canonical_id) for r in aliases} == {("a-k1", "b-k1"), ("a-k2", "b-k2"), ("z", "b-k1")}
    refused = migration.migrate(spark, root, "r4", raw.union(raw), build("c-"), {"things": "k"})
    assert not refused["passed"]
    assert snapshots.active(spark, root) == second["snapshot"]


def test_views_follow_one_snapshot(spark, tmp_path):
    root, one = str(tmp_path), spark.createDataFrame([("a",)], "id string")
    assert snapshots.open_views(spark, root, "v_") == {}
    snapshots.publish(spark, root, "r1", {"x": one, "y": one, "z": one}, available={"x", "y"})
    assert set(snapshots.open_views(spark, root, "v_")) == {"v_x", "v_y"}
    snapshots.publish(spark, root, "r2", {"x": one.unionByName(spark.createDataFrame([("b",)], "id string"))})
    assert (spark.table("v_x").count(), spark.table("v_y").count()) == (1, 1)
    assert set(snapshots.open_views(spark, root, "v_")) == {"v_x"}
    assert spark.table("v_x").count() == 2
    assert not spark.catalog.tableExists("v_y")


def test_white_space_of_any_script_is_cut(spark):
    blanks = [" ", "\t", "-\n", "  \r\n", "\x1c", " н/д "]
    rows = spark.createDataFrame([(b,) for b in blanks], "s string")
    parsed = rows.select(numbers.parse_decimal(F.col("s")).alias("n"), numbers.parse_int(F.col("s")).alias("i")).collect()
    assert all(r.n.value is None and r.n.warning is None and r.i.warning is None for r in parsed)
    one = spark.createDataFrame([("\t", " next\n", "\tда\n", "7 ")], "a string, b string, c string, d string")
    got = one.select(text.first_text(F.col("a"), F.col("b")).alias("t"), text.bool_or_none(F.col("c")).alias("c"), numbers.positive_int(F.col("d")).alias("d"), text.stripped(F.lit(None)).alias("none")).first()
    assert tuple(got) == ("next", True, 7, None)
    schema = "source_key string, provenance struct<source_key:string,source_page:string,list_api:string,detail_api:string,detail_page:string,raw_snapshot_path:string>, legacy_ids array<string>"
    records = spark.createDataFrame([("\t", ("", "https://h/x", None, None, None, None), [" "]), ("k", ("k\n", "https://h/x", None, None, None, None), None)], schema)
    assert sorted((r.source_key, r.rule) for r in contracts.violations(records).collect()) == [("\t", "blank_legacy_id"), ("\t", "empty_source_key")]


def test_stored_aliases(spark, tmp_path):
    rows = spark.createDataFrame([(" major ", "a", "b"), (None, "c", "d"), ("x", "", "e"), ("x", "f", None)], snapshots.ALIAS)
    expected = {("major", "a", "b"), ("", "c", "d")}
    snapshots.write_aliases(rows, str(tmp_path / "folder"))
    assert {tuple(r) for r in snapshots.read_aliases(spark, str(tmp_path / "folder")).collect()} == expected
    (tmp_path / "file").mkdir()
    (tmp_path / "file" / "id_aliases.json").write_text('{"schema_version": "2.0",\n "aliases": [{"entity_type": "major ", "legacy_id": "a", "canonical_id": "b"},\n {"legacy_id": "c", "canonical_id": "d"}, {"legacy_id": ""}]}')
    assert {tuple(r) for r in snapshots.read_aliases(spark, str(tmp_path / "file")).collect()} == expected
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "id_aliases.json").write_text('{"aliases": [')
    assert snapshots.read_aliases(spark, str(tmp_path / "broken")).count() == 0
    assert snapshots.read_aliases(spark, str(tmp_path / "absent")).count() == 0


def test_a_dataset_that_cannot_be_read_is_an_error(spark, tmp_path):
    spark.createDataFrame([("a",)], "id string").write.parquet(str(tmp_path / "good"))
    assert set(files.read_snapshot(spark, str(tmp_path), ["good", "absent"])) == {"good"}
    (tmp_path / "bad").mkdir()
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        files.read_snapshot(spark, str(tmp_path), ["good", "bad"])


def test_examples_of_failed_checks_are_few(spark):
    schema = extraction.DOCUMENTS
    documents = spark.createDataFrame([(f"d{i % 40:02d}", "ok", [], []) for i in range(80)], schema)
    found = extraction.quality(extraction.flatten(documents), examples=5)
    assert found["failed"]["duplicate_documents"] == {"n": 40, "examples": [f"d{i:02d}" for i in range(5)]}


def test_variant_ids(spark):
    rows = spark.createDataFrame([("A", "x", 0), ("a ", "y", 1), ("a", "y", 2), ("B", "x", 3), (None, "x", 4), ("", "z", 5)], "k string, v string, at int")
    got = {r["at"]: r for r in ids.variant_ids(rows, "s", "kind", ["k"], ["v"], ["at"], ["at"]).collect()}
    plain = spark.range(1).select(ids.legacy_id("s", "kind", F.lit("b")).alias("b"), ids.legacy_id("s", "kind", F.lit("a"), F.lit("duplicate"), F.lit(2)).alias("second"), ids.legacy_id("s", "kind", F.lit(5)).alias("five")).first()
    assert (got[3].id, got[2].id, got[5].legacy_id) == (plain.b, plain.second, plain.five)
    assert len({r.id for r in got.values()}) == 6


def test_whole_numbers_need_no_python(spark):
    plan = spark.range(3).select(ids.stable_id("s", "k", F.col("id"), F.col("id").cast("double")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    keyed = ids.source_keys(spark.createDataFrame([(1, 2), (1, 3), (2, 2)], "k int, v int"), ["k"], ["v"], ["v"])
    assert "Python" not in keyed._jdf.queryExecution().executedPlan().toString()
    assert keyed.where("source_key = '2'").count() == 1


def test_table_class(spark):
    rows = spark.createDataFrame([(60, 900.0), (25, 0.0), (24, 699.0), (24, 700.0), (10, 5.0), (11, 5.0), (11, None)], "n int, x double")
    assert [r[0] for r in rows.select(tokens.table_class(F.col("n"), F.col("x"))).collect()] == ["curriculum", "calendar_schedule", "other", "time_budget_summary", "time_budget_summary", "other", "other"]


def test_metric_sums(spark):
    rows = spark.createDataFrame([(1, None, 0.0004), (2, 3, 1.0004)], "records int, failures int, duration_ms double")
    assert tuple(integrity.metric_sums(rows).first()) == (3, 0, 0, 3, 1.001)
    assert tuple(integrity.metric_sums(rows.limit(0)).first()) == (0, 0, 0, 0, 0.0)


def test_load_rows(spark):
    loads = spark.createDataFrame(
        [("l1", "d1", "doc", "t", 4, "1", "n", 1, None, True, True, 2.0, None, None, None, "Э", ["Э"], None, ["note"], 7, "row", ("2", "", "", "", "Э")), ("l2", "d1", "doc", "t", 4, "1", "n", 2, 17, False, False, None, None, None, None, "", [], [], [], 7, "row", ("", "", "", "", ""))],
        "load_id string, discipline_id string, document_id string, table_id string, row_index int, code string, name string, semester int, weeks int, active boolean, has_numeric_load boolean, credits double, hours double, audited_hours double, independent_or_other_hours double, "
        "control string, control_tokens array<string>, control_kinds array<string>, normalization_notes array<string>, page_number int, source_row_id string, raw struct<credits:string,hours:string,audited_hours:string,independent_or_other_hours:string,control:string>",
    )
    sources = spark.createDataFrame([("t", 4, 1, "credits", ["c2", "c1"], ["w1"]), ("t", 4, 1, "control", ["c1"], ["w9"]), ("t", 4, 0, "name", ["c0"], ["w0"])], "table_id string, row_index int, semester int, field string, cell_ids array<string>, word_ids array<string>")
    rows = curriculum.load_rows(loads, sources)
    assert tuple(rows.columns) == curriculum.LOAD_COLUMNS
    one, two = rows.orderBy("id").collect()
    assert (one.source_cell_ids, one.source_word_ids, one.control_tokens, one.control_kinds) == ('["c1","c2"]', '["w1","w9"]', '["Э"]', "[]")
    assert one.raw_bands.startswith('{"credits":{"text":"2","cell_ids":["c2","c1"],"word_ids":["w1"]},"hours":{"text":"","cell_ids":[],"word_ids":[]}')
    assert (two.source_cell_ids, two.raw) == ("[]", '{"credits":"","hours":"","audited_hours":"","independent_or_other_hours":"","control":""}')


def test_counts_of_manifest_and_documents(spark):
    from lectern.plans import materialized

    schema = "document_id string, status string, kind string, expected_size int, source_size int, expected_sha256 string, source_sha256 string, layout_text string, table_count int, row_count int, cell_count int"
    sources = spark.createDataFrame([("d1", "ok", "docx", None, 1, None, "x", "t", None, None, None)], schema)
    flat = {"tables": spark.createDataFrame([], "document_id string, table_id string, row_count int, column_count int"), "rows": spark.createDataFrame([], "table_id string, document_id string, row_index int"), "cells": spark.createDataFrame([], "table_id string, document_id string, row_index int")}
    manifest = spark.createDataFrame([("d1", "a", "p", "u", None, True), ("d1", "a", "q", "u", None, True), ("d2", "b", "p", "u", None, True), ("d3", "", "p", "u", None, False)], "document_id string, local_path string, program_id string, plan_url string, resolved_url string, valid boolean")
    found = {r.check: (r.passed, list(r.examples)) for r in materialized.validate(sources, flat, manifest, manifest.drop("valid").limit(2), spark.createDataFrame([("a",)], "path string")).collect()}
    assert found["canonical_document_count_matches_manifest"] == (False, ["2 and 1"])
    assert found["manifest_reference_count_matches_attached"] == (False, ["4 and 2"])
    assert len(found) == 15


def test_every_kind_of_entity(spark):
    from lectern.plans import entities

    source = spark.createDataFrame(
        [("k", "Name", None, "3", "", "7,5", "x", "f", {"a": "1"}, ["old"], ("k", "https://h/x", None))],
        "source_key string, name string, code string, number string, department_key string, minimum_score string, program_key string, faculty_key string, raw map<string,string>, legacy_ids array<string>, provenance struct<source_key:string,source_url:string,raw_snapshot_path:string>",
    )
    for kind, spec in entities.ENTITIES.items():
        rows = entities.project(kind, source, "S")
        assert rows.columns == ["id", "scope", *spec.values, *spec.references, *spec.always, "field_meta", "extensions", "provenance"]
        row = rows.first()
        assert row.id.startswith(f"university:s:{kind}:")
        assert set(row.field_meta) == set(spec.meta)
        assert row.extensions["S"]["legacy_ids"] == '["old"]'
    off = entities.project("department", source, "S", {"faculties": False}).first()
    assert (off.faculty_id, off.extensions["S"]["unresolved_references"]) == ("", '{"faculty_key":"f"}')
    assert entities.project("teacher", source, "S", {}).first().extensions["S"].get("unresolved_references") is None
    assert entities.project("semester", source, "S").first().number == 3
    score = entities.project("admission_requirement", source, "S").first()
    assert (score.minimum_score, score.field_meta["minimum_score"].status) == (None, "not_published")
    told = source.withColumn("resolution", F.struct(F.lit(36).alias("value"), F.lit("derived").alias("status"), F.lit("m").alias("method"), F.lit(0.5).alias("confidence"), F.array(F.lit("w")).alias("warnings")))
    hours = entities.project("discipline", told, "S").first()
    assert (hours.total_hours, hours.field_meta["total_hours"].status, hours.field_meta["total_hours"].warnings) == (36.0, "derived", ["w"])
    assert entities.project("program", source.limit(0), "S").count() == 0


def test_quality_report_tells_sums_and_refuses_strangers(spark):
    from lectern.plans import canonical

    metrics = spark.createDataFrame([("a", 3, 1, 0.5), ("b", 4, 0, 0.25)], "capability string, records int, failures int, duration_ms double")
    told = canonical.quality_report({}, "s", {"a": False}, {}, warnings={"a": ["w"]}, gaps={"a": ["g", "h"]}, metrics=metrics)
    assert told["metrics"] == {"records": 7, "warnings": 1, "gaps": 2, "failures": 1, "duration_ms": 0.75}
    assert told["passed"]
    assert not canonical.quality_report({}, "s", {"a": False}, {}, warnings={"z": ["w"]})["passed"]
    assert not canonical.quality_report({}, "s", {"a": False}, {}, gaps={"a": [" \t"]})["passed"]


def test_rows_with_their_cells_and_old_entries(spark):
    flat = {"rows": spark.createDataFrame([("t", 0), ("t", 1)], "table_id string, row_index int"), "cells": spark.createDataFrame([("t", 0, i, f"c{i}") for i in (2, 0, 10)], "table_id string, row_index int, column_index int, cell_id string")}
    assert {r.row_index: r.cell_ids for r in extraction.row_cells(flat).collect()} == {0: ["c0", "c2", "c10"], 1: []}
    entries = spark.sql("SELECT * FROM VALUES (1, timestamp'2026-01-01 00:00:00'), (2, timestamp'2026-01-01 00:00:11'), (3, null) AS e(k, at)")
    kept = snapshots.unexpired(entries, "at", 10, F.lit("2026-01-01 00:00:20").cast("timestamp"))
    assert {r.k for r in kept.collect()} == {2, 3}


def test_examples_of_a_reconciliation(spark):
    declared = spark.createDataFrame([(i, 5.0 if i % 2 else None, 1.0) for i in range(30)], "k int, a double, b double")
    detail = spark.createDataFrame([(i, 5.0, 2.0) for i in range(10)], "f int, x double, y double")
    found = integrity.reconcile(declared, "k", detail, "f", {"a": ("a", F.col("x")), "b": ("b", F.col("y"))}, F.col("x") > 0)
    rows = integrity.reconciliation_examples(found, ["a", "b"], ["k"], most=22).collect()
    assert [r.k for r in rows] == [*range(10, 30), 0, 1]
    assert rows[0].differences == {"b": -1.0}
    assert rows[1].differences == {"a": -5.0, "b": -1.0}
