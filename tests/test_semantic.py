"""The semantic report, the contract of sources and what blocks a publication, on small tables with one fault each."""

import pytest
from pyspark.sql import functions as F

from lectern.plans import contracts, semantic


def frames(spark):
    tables = spark.createDataFrame([("t1", "d1"), ("t2", "d2")], "table_id string, document_id string")
    schemas = spark.createDataFrame([("d1", 2, []), ("d2", 2, [])], "document_id string, semester_count int, warnings array<string>")
    rows = spark.createDataFrame([("r1", ["c"]), ("r2", ["c"])], "id string, source_cell_ids array<string>")
    disciplines = spark.createDataFrame([("x", "1", "Algebra", "", "unknown", 2.0, None, 72.0), ("y", "2", "Law", "d", "mandatory", None, 10.0, 36.0)], "id string, code string, name string, department string, part_type string, credits double, audited_hours double, hours double")
    loads = spark.createDataFrame([("l1", "x", 1, True, True, "Экз", ["Экз"], {"hours": "72"}, 72.0), ("l2", "y", 1, False, False, "", [], {}, None)], "id string, discipline_id string, semester int, active boolean, has_numeric_load boolean, control string, control_tokens array<string>, raw map<string,string>, hours double")
    return [tables, schemas, rows, disciplines, loads, tables.select("table_id")]


def failing(parts):
    return {r.check: (r.n, r.examples) for r in semantic.report(*parts).collect() if not r.passed and r.check != "passed"}


def test_report(spark):
    good = frames(spark)
    whole = {r.check: r.passed for r in semantic.report(*good).collect()}
    assert len(whole) == 18 and all(whole.values())
    tables, schemas, rows, disciplines, loads, read = good
    cases = [
        ([tables, schemas, rows, disciplines, loads, read.where("table_id = 't1'")], {"all_curriculum_tables_read": (1, ["t2"])}),
        ([tables, schemas.where("document_id = 'd1'"), rows, disciplines, loads, read], {"all_curriculum_documents_have_schema": (1, ["t2"])}),
        ([tables, schemas.withColumn("warnings", F.array(F.lit("w"))), rows, disciplines, loads, read], {"no_schema_warnings": (2, ["d1", "d2"])}),
        ([tables, schemas, rows.withColumn("source_cell_ids", F.lit(None).cast("array<string>")), disciplines, loads, read], {"all_semantic_rows_reference_cells": (2, ["r1", "r2"]), "curriculum_contract_semantic_rows_have_source_cells": (2, ["r1", "r2"])}),
        ([tables, schemas, rows, disciplines.unionByName(disciplines.where("id = 'y'")), loads, read], {"discipline_ids_unique": (1, ["y"]), "curriculum_contract_unique_discipline_ids": (1, ["y"])}),
        ([tables, schemas, rows, disciplines.withColumn("name", F.lit("")), loads, read], {"discipline_subject_fields_present": (2, ["x", "y"]), "curriculum_contract_discipline_code_and_name_present": (2, ["x", "y"])}),
        ([tables, schemas, rows, disciplines, loads.withColumn("discipline_id", F.when(F.col("id") == "l2", "z").otherwise("x")), read], {"semester_loads_reference_disciplines": (1, ["l2"]), "curriculum_contract_semester_loads_reference_disciplines": (1, ["l2"])}),
        ([tables, schemas, rows, disciplines, loads.withColumn("hours", F.lit(70.0)), read], {"allocated_semester_totals_reconcile": (1, ["x"])}),
        ([tables, schemas, rows, disciplines, loads.withColumn("raw", F.create_map(F.lit("credits"), F.lit("2 Зчт"))), read], {"no_control_tokens_in_numeric_semester_fields": (2, ["l1:credits", "l2:credits"])}),
        ([tables, schemas, rows, disciplines, loads.withColumn("control_tokens", F.array().cast("array<string>")), read], {"all_control_fields_classified": (1, ["l1"])}),
        ([tables, schemas, rows, disciplines, loads.withColumn("active", F.lit(True)).withColumn("control", F.lit(" ")).withColumn("hours", F.when(F.col("id") == "l1", 72.0).otherwise(36.0)), read], {"no_unexplained_active_semester_rows": (1, ["l2"])}),
    ]
    for parts, expected in cases:
        assert failing(parts) == expected
    empty = [df.limit(0) for df in good]
    assert failing(empty) == {}


def test_gaps_and_warnings(spark):
    _, _, rows, disciplines, loads, _ = frames(spark)
    gaps = {r.gap: r.n for r in semantic.source_gaps(disciplines, loads).collect()}
    assert gaps == {"disciplines_without_total_credits": 1, "disciplines_without_audited_hours": 1, "disciplines_without_department": 1, "disciplines_with_unknown_part_type": 1, "unallocated_total_without_semester_rows": 1}
    assert [tuple(r) for r in semantic.contract_violations(rows, disciplines, loads).select("rule", "severity", "name").collect()] == [("known_part_type", "warning", "x")]


def test_failures(spark):
    rows = [("a", {"p": {"semantic_report": '{"verification":{"passed":false}}'}}), ("b", {"p": {"semantic_report": '{"verification":{"passed":true}}', "semantic_warnings": '["w"]'}}), ("c", {"p": {"semantic_reports": '[{"verification":{"passed":true}},{"verification":{"passed":false}}]'}}), ("d", {}), ("e", None), ("f", {"p": {"semantic_report": "no json"}})]
    df = spark.createDataFrame(rows, "id string, extensions map<string,map<string,string>>")
    assert {(r.id, r.kind) for r in semantic.failures(df).collect()} == {("a", "report"), ("b", "warnings"), ("c", "report")}


def test_source_contract(spark):
    schema = "source_key string, provenance struct<source_page:string,list_api:string,detail_api:string,detail_page:string,source_key:string,raw_snapshot_path:string>, legacy_ids array<string>"
    fine = ("k", ("https://h/x", "", "", "", "k", "raw"), ["a"])
    rows = [fine, (" ", None, None), ("m", ("none", None, None, None, "n", ""), ["", None]), ("p", ("", "", "", "file:x", "p", ""), None), ("p", ("", "", "", "file:x", "p", ""), None)]
    got = sorted((r.source_key, r.rule) for r in contracts.violations(spark.createDataFrame(rows, schema)).collect())
    assert got == [(" ", "empty_source_key"), (" ", "no_provenance"), ("m", "blank_legacy_id"), ("m", "no_locator"), ("m", "provenance_of_another_key"), ("p", "duplicate_source_key")]
    assert ("p", "no_lineage") in {(r.source_key, r.rule) for r in contracts.violations(spark.createDataFrame(rows, schema), persists_raw=True).collect()}
    assert contracts.check(spark.createDataFrame([fine], schema), persists_raw=True).count() == 1
    with pytest.raises(ValueError, match="no_provenance"):
        contracts.check(spark.createDataFrame(rows, schema))
    with pytest.raises(ValueError, match="partial"):
        contracts.check(spark.createDataFrame([fine], schema), complete=False)
    with pytest.raises(ValueError, match="blank"):
        contracts.check(spark.createDataFrame([fine], schema), warnings=(" ",))
