"""Whether what was extracted is all there: manifest, files, documents and their flat tables held against one another.

sources: document_id, status, kind, expected_size, source_size, expected_sha256, source_sha256, layout_text and the declared table_count, row_count, cell_count (null: not declared).
manifest and attached: the REFERENCE columns; manifest also valid. files: path. flat: tables (document_id, table_id, row_count, column_count), rows and cells (table_id, document_id, row_index).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.lineage import written
from lectern.functions.text import stripped
from lectern.operators.integrity import first_values
from lectern.operators.relations import multiset_difference

REFERENCE = ("document_id", "local_path", "program_id", "plan_url", "resolved_url")
#: Statuses of documents that failed (fixed values).
FAILED = ("missing", "invalid_source", "error")
#: Names of the checks (fixed values).
CHECKS = (
    "canonical_document_count_matches_manifest", "manifest_reference_count_matches_attached", "all_manifest_references_attached", "all_referenced_files_exist", "no_invalid_or_failed_documents", "all_pdf_tables_detected", "all_pdf_raw_layout_captured", "source_sizes_match_metadata", "source_hashes_match_metadata",
    "document_counts_match_materialized_data", "table_counts_match_materialized_data", "all_table_rows_and_cells_materialized", "no_unreferenced_downloads", "all_manifest_references_valid",
)


def _named(check: str, df: DataFrame, name: Column | str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), (F.col(name) if isinstance(name, str) else name).cast("string").alias("name"))


def materialized(sources: DataFrame, flat: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(documents, tables): declared counts next to those of the flat tables, which are aggregated before they are joined."""
    of_rows = flat["rows"].groupBy("table_id").agg(F.count("*").alias("rows"))
    of_cells = flat["cells"].groupBy("table_id").agg(F.count("*").alias("cells"))
    counted = flat["tables"].join(of_rows, "table_id", "left").join(of_cells, "table_id", "left").fillna(0, ["rows", "cells"])
    by_document = counted.groupBy("document_id").agg(F.count("*").alias("tables"), F.sum("rows").alias("rows"), F.sum("cells").alias("cells"))
    return sources.join(by_document, "document_id", "left").fillna(0, ["tables", "rows", "cells"]), counted


def findings(sources: DataFrame, flat: dict[str, DataFrame], manifest: DataFrame, attached: DataFrame, files: DataFrame) -> DataFrame:
    """(check, name) of everything that fails a check."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    path = F.translate(blank("local_path"), "\\", "/")
    key = lambda df: df.select(*[blank(c).alias(c) for c in REFERENCE])
    # Counted once: five checks read the documents' counts, two the tables'.
    documents, tables = (written(df) for df in materialized(sources, flat))
    off = F.lit(False)
    for declared, actual in (("table_count", "tables"), ("row_count", "rows"), ("cell_count", "cells")):
        off = off | F.coalesce(F.col(declared) != F.col(actual), F.lit(False))
    wrong_documents, wrong_tables = documents.where(off), tables.where(F.coalesce(F.col("row_count") != F.col("rows"), F.lit(False)))
    known, there = attached.select(path.alias("path")).where("path <> ''"), files.select("path")
    empty = flat["cells"].agg(F.count("*").alias("n")).where("n = 0")
    pdf = F.col("kind") == "pdf"
    counts = lambda left, right: left.agg(F.count("*").alias("a")).join(F.broadcast(right.agg(F.count("*").alias("b")))).where("a <> b")  # noqa: E731 - one row each
    told = F.concat_ws(" and ", "a", "b")
    once = manifest.where(path != "").select("document_id").distinct()
    parts = [
        _named("canonical_document_count_matches_manifest", counts(once, sources), told),
        _named("manifest_reference_count_matches_attached", counts(manifest, attached), told),
        _named("all_manifest_references_attached", multiset_difference(key(manifest), key(attached)), F.concat_ws("|", *REFERENCE)),
        _named("all_referenced_files_exist", known.join(there, "path", "left_anti"), "path"),
        _named("no_invalid_or_failed_documents", sources.where(F.col("status").isin(*FAILED)), "document_id"),
        _named("all_pdf_tables_detected", documents.where(pdf & (F.coalesce("table_count", F.lit(0)) == 0)), "document_id"),
        _named("all_pdf_raw_layout_captured", sources.where(pdf & (stripped(blank("layout_text")) == "")), "document_id"),
        _named("source_sizes_match_metadata", sources.where(F.col("expected_size").isNotNull() & ~F.col("expected_size").eqNullSafe(F.col("source_size"))), "document_id"),
        _named("source_hashes_match_metadata", sources.where((blank("expected_sha256") != "") & (F.lower("expected_sha256") != F.lower(blank("source_sha256")))), "document_id"),
        _named("document_counts_match_materialized_data", wrong_documents, "document_id"),
        _named("table_counts_match_materialized_data", wrong_tables, "table_id"),
        _named("all_table_rows_and_cells_materialized", wrong_documents, "document_id"),
        _named("all_table_rows_and_cells_materialized", wrong_tables, "table_id"),
        _named("all_table_rows_and_cells_materialized", empty, F.lit("no cells")),
        _named("no_unreferenced_downloads", there.join(known, "path", "left_anti"), "path"),
        _named("all_manifest_references_valid", manifest.where(~F.coalesce("valid", F.lit(True))), F.concat_ws("|", *REFERENCE)),
    ]
    return reduce(DataFrame.unionByName, parts)


def validate(sources: DataFrame, flat: dict[str, DataFrame], manifest: DataFrame, attached: DataFrame, files: DataFrame, most: int = 20) -> DataFrame:
    """(check, passed, n, examples): each check, how many different things fail it and the first `most`; the row "passed" is for all together."""
    failed = first_values(written(findings(sources, flat, manifest, attached, files)), ["check"], "name", most).withColumnRenamed("check", "failed")
    names = sources.sparkSession.createDataFrame([(c,) for c in CHECKS], "check string")
    none = F.array().cast("array<string>")
    each = names.join(failed, F.col("check") == F.col("failed"), "left").select("check", F.col("failed").isNull().alias("passed"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("examples", none).alias("examples"))
    whole = each.agg(F.bool_and("passed").alias("passed"), F.sum("n").alias("n")).select(F.lit("passed").alias("check"), "passed", "n", none.alias("examples"))
    return each.unionByName(whole)
