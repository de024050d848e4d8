"""Flattening and quality of extracted documents."""

from lectern.plans import curriculum, extraction

WORDS = [("w1", "a", 0.0, 0.0, 1.0, 1.0), ("w1", "a", 0.0, 0.0, 1.0, 1.0)]


def table(rows, row_count, columns=2):
    return (0, 1, "curriculum", row_count, columns, 0.0, 10.0, rows)


def test_flatten_and_quality(spark):
    rows = [[("h", 0.0, 5.0, ["w1"]), ("i", 5.0, 10.0, [])], None, [("x", 0.0, 5.0, []), None]]
    docs = spark.createDataFrame([("d", "ok", [(1, 10.0, 10.0, WORDS)], [table(rows, 2)]), ("e", "missing", None, None)], extraction.DOCUMENTS)
    flat = extraction.flatten(docs)
    assert {n: df.count() for n, df in flat.items()} == {"documents": 2, "pages": 1, "words": 1, "tables": 1, "rows": 2, "cells": 3}
    assert sorted((r.row_index, r.first_cell, r.second_cell, r.cell_count) for r in flat["rows"].collect()) == [(0, "h", "i", 2), (2, "x", "", 1)]
    report = extraction.quality(flat)
    assert report == {"passed": True, "statuses": {"ok": 1, "missing": 1}, "failed": {}}
    bad = spark.createDataFrame([("d", "ok", [], [table([[("h", 0.0, 5.0, ["w9"])]], 2, 0)]), ("d", "ok", [], [])], extraction.DOCUMENTS)
    failed = extraction.quality(extraction.flatten(bad))["failed"]
    assert {k: v["n"] for k, v in failed.items()} == {"duplicate_documents": 1, "declared_row_counts": 1, "declared_column_counts": 1, "unknown_words": 1}
    assert extraction.first_tables(flat["tables"].unionByName(flat["tables"])).count() == 1


def test_flat_tables_feed_the_curriculum(spark):
    head = [("Шифр", 0.0, 5.0, []), ("Наименование", 5.0, 10.0, []), ("1 - 17 недель", 50.0, 100.0, [])]
    body = [("1", 0.0, 5.0, []), ("Алгебра", 5.0, 10.0, []), ("2", 50.0, 60.0, [])]
    rows = [head, [], [], [], body]
    docs = spark.createDataFrame([("d", "ok", [], [(0, 1, "curriculum", 5, 3, 0.0, 100.0, rows)])], extraction.DOCUMENTS)
    flat = extraction.flatten(docs)
    schemas = curriculum.discover_schemas(flat["tables"], flat["cells"])
    found = curriculum.semantic_rows(curriculum.band_texts(flat["tables"], flat["cells"], flat["words"], schemas))
    loads = curriculum.semester_loads(curriculum.disciplines(found)).collect()
    assert [(r.name, r.semester, r.credits) for r in loads] == [("Алгебра", 1, 2.0)]
