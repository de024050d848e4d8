"""XLSX and DOCX files as rows: each file is parsed in the task that reads it."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_DOC = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _place(name: str) -> tuple[int, int]:
    """(row, column) from 1 of a cell name such as B12."""
    letters, digits = re.fullmatch(r"([A-Z]+)(\d+)", name).groups()
    column = 0
    for c in letters:
        column = column * 26 + ord(c) - 64
    return int(digits), column


def sheet_rows(content: bytes, sheet: str | None = None) -> list[tuple[str, int, dict[str, str]]]:
    """(sheet, row number, values by heading) of one sheet, the first by default. The first row holds the headings, empty ones are dropped; an empty cell in a merged range takes
    the range's first value; rows without a value are left out."""
    book = zipfile.ZipFile(io.BytesIO(content))
    names = set(book.namelist())
    strings = []
    if "xl/sharedStrings.xml" in names:
        strings = ["".join(t.text or "" for t in si.iter(f"{_SHEET}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    sheets = [(s.get("name"), targets[s.get(_LINK)]) for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_SHEET}sheet")]
    chosen = next(((n, t) for n, t in sheets if sheet in (None, n)), None)
    if chosen is None:
        return []
    root = ElementTree.fromstring(book.read("xl/" + chosen[1].removeprefix("/xl/").removeprefix("xl/")))
    cells: dict[tuple[int, int], str] = {}
    for c in root.iter(f"{_SHEET}c"):
        value, kind = c.findtext(f"{_SHEET}v"), c.get("t")
        text = "".join(t.text or "" for t in c.iter(f"{_SHEET}t")) if kind == "inlineStr" else strings[int(value)] if kind == "s" and value else value
        if text not in (None, ""):
            cells[_place(c.get("r"))] = text
    for merge in root.iter(f"{_SHEET}mergeCell"):
        (r0, c0), (r1, c1) = (_place(x) for x in merge.get("ref").split(":"))
        for r in range(r0, r1 + 1):
            for c in range(c0, c1 + 1):
                if (r0, c0) in cells:
                    cells.setdefault((r, c), cells[r0, c0])
    headings = {c: v.strip() for (r, c), v in cells.items() if r == 1 and v.strip()}
    rows: dict[int, dict[str, str]] = {}
    for (r, c), v in sorted(cells.items()):
        if r > 1 and c in headings:
            rows.setdefault(r, {})[headings[c]] = v
    return [(chosen[0], r, values) for r, values in sorted(rows.items())]


def _own_text(paragraph: ElementTree.Element) -> str:
    """A paragraph's text: its runs and those of its links, tabs and breaks as characters."""
    out = []
    for run in [r for x in paragraph for r in ([x] if x.tag == f"{_DOC}r" else x.findall(f"{_DOC}r") if x.tag == f"{_DOC}hyperlink" else [])]:
        for x in run:
            kind = x.tag.removeprefix(_DOC)
            out.append(x.text or "" if kind == "t" else "\t" if kind == "tab" else "\n" if kind in ("br", "cr") else "-" if kind == "noBreakHyphen" else "")
    return "".join(out)


def _number(element: ElementTree.Element | None, path: str, default: int) -> int:
    found = None if element is None else element.find("/".join(_DOC + p for p in path.split("/")))
    return default if found is None else int(found.get(f"{_DOC}val"))


def _grid(table: ElementTree.Element) -> list[tuple[int, int, str, bool]]:
    """(row, column, text, merged) of every place of a table's grid that a cell covers: cells over several columns or rows give their text at each; merged is true but for the first place."""
    out, above = [], {}
    for r, row in enumerate(table.findall(f"{_DOC}tr")):
        column, now = _number(row, "trPr/gridBefore", 0), {}
        for cell in row.findall(f"{_DOC}tc"):
            merge = cell.find(f"{_DOC}tcPr/{_DOC}vMerge")
            below = merge is not None and merge.get(f"{_DOC}val", "continue") == "continue" and column in above
            text = above[column] if below else "\n".join(_own_text(p) for p in cell.findall(f"{_DOC}p"))
            for c in range(column, column + _number(cell, "tcPr/gridSpan", 1)):
                out.append((r, c, text, below or c > column))
                now[c] = text
            column += _number(cell, "tcPr/gridSpan", 1)
        above = now
    return out


def document_parts(content: bytes) -> list[tuple[int, str, int | None, int | None, int | None, str, bool]]:
    """(place, kind, index, row, column, text, merged) of a DOCX file's body in its order: kind paragraph, with its number, or cell, with its table's number and place in the grid. All from 0.
    Tables inside of cells are part of neither."""
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{_DOC}body")
    out, paragraphs, tables = [], 0, 0
    for place, x in enumerate([] if body is None else body):
        if x.tag == f"{_DOC}p":
            out.append((place, "paragraph", paragraphs, None, None, _own_text(x), False))
            paragraphs += 1
        elif x.tag == f"{_DOC}tbl":
            out += [(place, "cell", tables, r, c, text, merged) for r, c, text, merged in _grid(x)]
            tables += 1
    return out


def document_cells(content: bytes) -> list[tuple[int, int, int, str]]:
    """(table, row, column, text) of a DOCX file's tables, each from 0, merged cells at every place they cover."""
    return [(table, row, column, text) for _, kind, table, row, column, text, _ in document_parts(content) if kind == "cell"]


def _parsed(files: DataFrame, schema: str, columns: list[str], parse) -> DataFrame:
    """Rows of every file (path, content), or one row with the status for a file that can't be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for p, content in batch.itertuples(index=False):
                try:
                    out += [(p, "ok", *row) for row in parse(bytes(content))] or [(p, "empty", *[None] * len(columns))]
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError) as e:
                    out.append((p, f"error: {type(e).__name__}", *[None] * len(columns)))
            yield pd.DataFrame(out, columns=["path", "status", *columns])

    return files.select("path", "content").mapInPandas(run, f"path string, status string, {schema}")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def xlsx_rows(files: DataFrame, sheet: str | None = None) -> DataFrame:
    """(path, status, sheet, row, values) of spreadsheets (path, content)."""
    return _parsed(files, "sheet string, row int, values map<string,string>", ["sheet", "row", "values"], lambda content: sheet_rows(content, sheet)).withColumn("row", F.col("row").cast("int"))


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    return xlsx_rows(_files(spark, path), sheet)


def read_docx_tables(spark: SparkSession, path: str) -> DataFrame:
    return _parsed(_files(spark, path), "table_index int, row_index int, column_index int, text string", ["table_index", "row_index", "column_index", "text"], document_cells)


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """(path, status, place, kind, index, row, column, text, merged) of document_parts(), or a row with the status of a file that is empty or can't be read."""
    columns = ["place", "kind", "index", "row", "column", "text", "merged"]
    return _parsed(_files(spark, path), "place int, kind string, index int, row int, column int, text string, merged boolean", columns, document_parts)
