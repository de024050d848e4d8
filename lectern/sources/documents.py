"""Documents of a manifest, each with a status, whatever becomes of its file."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import sniff
from lectern.sources.office import document_parts

_CELL = "struct<text:string,x0:double,x1:double,word_ids:array<string>>"
_WORD = "struct<id:string,text:string,x0:double,top:double,x1:double,bottom:double>"
#: What is read from a document; words and tables as plans.extraction takes them.
BODY = (
    f"pages array<struct<page_number:int,width:double,height:double,words:array<{_WORD}>,lines:array<string>>>, "
    f"tables array<struct<table_index:int,page_number:int,section:string,row_count:int,column_count:int,x0:double,x1:double,rows:array<array<{_CELL}>>>>"
)


def read_office(content: bytes) -> tuple[list[dict], list[dict]]:
    """Pages and tables of a DOCX file: one page with the paragraphs as lines, and its tables as grids."""
    parts = document_parts(content)
    tables: dict[int, dict[int, list[tuple[int, str]]]] = {}
    for _, kind, index, row, column, text, _ in parts:
        if kind == "cell":
            tables.setdefault(index, {}).setdefault(row, []).append((column, text))
    cell = lambda text: {"text": text, "x0": None, "x1": None, "word_ids": []}
    out = []
    for index, rows in tables.items():
        grid = [[cell(text) for _, text in rows.get(r, [])] for r in range(max(rows) + 1)]
        out.append({"table_index": index, "page_number": 1, "section": "office_table", "row_count": len(grid), "column_count": max(map(len, grid)), "x0": None, "x1": None, "rows": grid})
    return [{"page_number": 1, "width": None, "height": None, "words": [], "lines": [p[5] for p in parts if p[1] == "paragraph"]}], out


READERS: dict[str, Callable[[bytes], tuple[list[dict], list[dict]]]] = {"docx": read_office}


def listed(spark: SparkSession, root: str) -> DataFrame:
    """(local_path, content) of the files under a folder, paths as seen from it. The content is read only where it is asked for. Spark doesn't list empty files: a document with
    such a file is missing."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    base = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.substring("path", len(base) + 1, 1_000_000).alias("local_path"), "content")


def extract(manifest: DataFrame, files: DataFrame, readers: Mapping[str, Callable[[bytes], tuple[list[dict], list[dict]]]] = READERS, kinds: tuple[str, ...] = ("pdf", "docx")) -> DataFrame:
    """A row for every row of `manifest` (document_id, local_path, ...), with kind, status, error, source_size, source_sha256, pages, tables, and their counts page_count, paragraph_count, table_count,
    row_count and cell_count.

    status is missing (no such file, or no path), invalid_source (a kind other than `kinds`), error (no reader for the kind, or the reader failed: error says how), ok_no_tables or ok. Backslashes in
    paths count as slashes. A docx is told by its first bytes and its name. A file that several rows name is read once; files that no row names aren't read. A failure stays with its file.
    """
    path = F.translate("local_path", "\\\\", "/")
    asked = manifest.withColumn("_path", path)
    wanted = asked.select("_path").where("_path is not null").distinct()
    found = files.select(F.col("local_path").alias("_path"), "content").join(wanted, "_path", "left_semi")
    by_bytes = sniff(F.col("content"))
    found = found.select("_path", F.when((by_bytes == "docx") & ~F.lower("_path").endswith(".docx"), "unknown").otherwise(by_bytes).alias("kind"), F.length("content").cast("long").alias("source_size"), F.sha2("content", 256).alias("source_sha256"), "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, kind, size, digest, content in batch.itertuples(index=False):
                status, error, pages, tables = "invalid_source", f"expected one of {', '.join(kinds)}, found {kind}", [], []
                if kind in kinds:
                    try:
                        if kind not in readers:
                            raise NotImplementedError(f"no reader for {kind}")
                        pages, tables = readers[kind](bytes(content))
                        status, error = "ok" if tables else "ok_no_tables", None
                    except Exception as e:  # noqa: BLE001 - whatever a reader does, the document keeps its row
                        status, error = "error", f"{type(e).__name__}: {e}"
                yield pd.DataFrame([(at, kind, status, error, size, digest, pages, tables)], columns=["_path", "kind", "status", "error", "source_size", "source_sha256", "pages", "tables"])

    # Files differ in size and a reader holds one whole, so they are dealt out by path, not gathered by their bytes.
    found = found.repartition(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_path")
    extracted = found.mapInPandas(read, f"_path string, kind string, status string, error string, source_size long, source_sha256 string, {BODY}")
    out = asked.join(extracted, "_path", "left").drop("_path")
    none = F.col("status").isNull()
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    total = lambda array, each: F.coalesce(F.aggregate(array, F.lit(0), lambda s, x: s + each(x)), F.lit(0))
    out = out.withColumns({
        "kind": F.coalesce("kind", F.lit("missing")), "status": F.coalesce("status", F.lit("missing")), "source_size": F.coalesce("source_size", F.lit(0)), "source_sha256": F.coalesce("source_sha256", F.lit("")),
        "error": F.when(none, F.concat(F.lit("file not found: "), F.coalesce("local_path", F.lit("")))).otherwise(F.col("error")), "pages": F.coalesce("pages", F.array()), "tables": F.coalesce("tables", F.array()),
    })
    return out.withColumns({
        "page_count": size("pages"), "paragraph_count": total("pages", lambda p: F.size(p["lines"])), "table_count": size("tables"), "row_count": total("tables", lambda t: t["row_count"]),
        "cell_count": total("tables", lambda t: F.aggregate(t["rows"], F.lit(0), lambda s, r: s + F.size(r))),
    })
