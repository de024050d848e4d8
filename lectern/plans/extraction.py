"""Extracted documents (nested) to flat tables, and what their quality is.

documents: document_id, status, pages array<struct<page_number, width, height, words array<struct<id,text,x0,top,x1,bottom>>>>, tables array<struct<table_index, page_number, section,
row_count, column_count, x0, x1, rows array<array<struct<text,x0,x1,word_ids>>>>>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.ids import legacy_id
from lectern.functions.lineage import written
from lectern.functions.text import _normalize_key
from lectern.operators import integrity
from lectern.operators.relations import broken

DOCUMENTS = (
    "document_id string, status string, pages array<struct<page_number:int,width:double,height:double,words:array<struct<id:string,text:string,x0:double,top:double,x1:double,bottom:double>>>>, "
    "tables array<struct<table_index:int,page_number:int,section:string,row_count:int,column_count:int,x0:double,x1:double,rows:array<array<struct<text:string,x0:double,x1:double,word_ids:array<string>>>>>>"
)


def _part_id(scope: str, kind: str, *parts: Column) -> Column:
    """legacy_id() of parts that are in its form already: a table's _key and ordinals. So rows and cells need no Python."""
    return F.concat(F.lit(f"{scope}:{kind}:"), F.substr(F.sha1(F.concat_ws("|", F.lit(kind), *parts)), F.lit(1), F.lit(20)))


# The outer forms read an array once; posexplode() would add a filter on its size that makes it again. Null places are left out anyway.
def _tables(documents: DataFrame, scope: str) -> DataFrame:
    """The tables with their rows and _key, the table's id as a part of other ids."""
    tables = documents.select("document_id", F.posexplode_outer("tables").alias("ordinal", "t")).where("t is not null")
    tables = tables.select(legacy_id(scope, "table", F.col("document_id"), F.col("t.table_index")).alias("table_id"), "document_id", "ordinal", "t.*")
    prefix = f"{scope}:table:"
    # The id is a fixed prefix and hex digits: what is normalised is the prefix.
    return tables.withColumn("_key", F.concat(F.lit(_normalize_key(prefix)), F.substr("table_id", F.lit(len(prefix) + 1))))


def _rows(tables: DataFrame) -> DataFrame:
    return tables.select("table_id", "document_id", "page_number", "section", "_key", F.posexplode_outer("rows").alias("row_index", "row")).where("row is not null")


def _told_rows(spread: DataFrame, scope: str, *more: Column) -> DataFrame:
    text = lambda i: F.coalesce(F.get("row", F.lit(i))["text"], F.lit(""))
    return spread.select(
        _part_id(scope, "row", F.col("_key"), F.col("row_index")).alias("row_id"), "table_id", "document_id", "page_number", "section", "row_index", text(0).alias("first_cell"), text(1).alias("second_cell"),
        F.size(F.array_compact("row")).alias("cell_count"), *more,
    )


def flatten(documents: DataFrame, scope: str = "plan") -> dict[str, DataFrame]:
    """documents, pages, words, tables, rows and cells. Ordinals come from the places in the arrays; null rows and cells keep their place and are left out."""
    tables = _tables(documents, scope)
    spread = _rows(tables)
    cells = spread.select("table_id", "document_id", "page_number", "section", "_key", "row_index", F.posexplode_outer("row").alias("column_index", "c")).where("c is not null")
    cells = cells.select(_part_id(scope, "cell", F.col("_key"), F.col("row_index"), F.col("column_index")).alias("cell_id"), "table_id", "document_id", "page_number", "section", "row_index", "column_index", "c.*")
    pages = documents.select("document_id", F.explode("pages").alias("p")).select("document_id", "p.*")
    words = pages.select("document_id", "page_number", F.explode("words").alias("w")).select("document_id", "page_number", F.col("w.id").alias("word_id"), "w.text", "w.x0", "w.x1", "w.top")
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    return {
        "documents": documents.select("document_id", "status", size("pages").alias("page_count"), size("tables").alias("table_count")),
        "pages": pages.drop("words"),
        "words": words.dropDuplicates(["document_id", "page_number", "word_id"]),
        "tables": tables.drop("rows", "_key"),
        "rows": _told_rows(spread, scope),
        "cells": cells,
    }


def rows_with_cells(documents: DataFrame, scope: str = "plan") -> DataFrame:
    """The rows of flatten() with cell_ids, the ids of their cells from left to right. Each row holds its cells, so nothing is joined."""
    named = F.transform("row", lambda c, i: F.when(c.isNotNull(), _part_id(scope, "cell", F.col("_key"), F.col("row_index"), i)))
    return _told_rows(_rows(_tables(documents, scope)), scope, F.array_compact(named).alias("cell_ids"))


def row_cells(flat: dict[str, DataFrame]) -> DataFrame:
    """rows_with_cells() of tables that are stored flat."""
    lists = flat["cells"].groupBy("table_id", "row_index").agg(F.transform(F.array_sort(F.collect_list(F.struct("column_index", "cell_id"))), lambda c: c["cell_id"]).alias("cell_ids"))
    return flat["rows"].join(lists, ["table_id", "row_index"], "left").withColumn("cell_ids", F.coalesce("cell_ids", F.array().cast("array<string>")))


def quality(flat: dict[str, DataFrame], examples: int = 20) -> dict:
    """Statuses, counts, and failed checks with up to `examples` names each; passed if none fails. A document that failed is a fact, not a failure."""
    counted = flat["rows"].groupBy("table_id").agg(F.count("*").alias("actual_rows"), F.max("cell_count").alias("actual_columns"))
    declared = flat["tables"].join(counted, "table_id", "left")
    wrong_rows = declared.where(F.coalesce("row_count", F.lit(0)) != F.coalesce("actual_rows", F.lit(0))).select(F.col("table_id").alias("name"))
    wrong_columns = declared.where(F.coalesce("actual_columns", F.lit(0)) > F.coalesce("column_count", F.lit(0))).select(F.col("table_id").alias("name"))
    wordless = broken(flat["cells"].select("document_id", "page_number", F.explode("word_ids").alias("word_id")).withColumn("name", F.concat_ws(":", "document_id", "page_number", "word_id")), "name",
                      flat["words"].withColumn("known", F.concat_ws(":", "document_id", "page_number", "word_id")), "known").select("name")
    failed = {
        "duplicate_documents": integrity.duplicate_ids(flat["documents"], "document_id").select(F.col("document_id").alias("name")),
        "duplicate_tables": integrity.duplicate_ids(flat["tables"], "table_id").select(F.col("table_id").alias("name")),
        "duplicate_cells": integrity.duplicate_ids(flat["cells"], "cell_id").select(F.col("cell_id").alias("name")),
        "tables_without_document": broken(flat["tables"], "document_id", flat["documents"], "document_id").select(F.col("table_id").alias("name")),
        "declared_row_counts": wrong_rows,
        "declared_column_counts": wrong_columns,
        "unknown_words": wordless,
    }
    every = None
    for check, df in failed.items():
        one = df.select(F.lit(check).alias("check"), "name")
        every = one if every is None else every.unionByName(one)
    found = integrity.first_values(written(every), ["check"], "name", examples).collect()
    statuses = {r.value: r.n for r in integrity.histogram(flat["documents"], "status", "documents").collect()}
    return {"passed": not found, "statuses": statuses, "failed": {r.check: {"n": r.n, "examples": list(r.examples)} for r in found}}


def write(flat: dict[str, DataFrame], path: str) -> None:
    for name, df in flat.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def first_tables(stored: DataFrame) -> DataFrame:
    """Of each table id the row that comes first in its document; what a rewrite of stored tables keeps."""
    best = stored.groupBy("table_id").agg(F.min_by(F.struct(*[c for c in stored.columns if c != "table_id"]), F.struct("document_id", "ordinal")).alias("b"))
    return best.select("table_id", "b.*").select(*stored.columns)
