"""Pages, words and lines from bounding-box XML, read by Spark's XML functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = "struct<_VALUE:string,_xMin:double,_yMin:double,_xMax:double,_yMax:double>"
_LINES = f"array<struct<word:array<{_WORD}>>>"
_BLOCKS = f"array<struct<line:{_LINES}>>"
_PAGES = f"array<struct<_width:double,_height:double,line:{_LINES},block:{_BLOCKS},flow:array<struct<line:{_LINES},block:{_BLOCKS}>>>>"
#: Pages stand in the root (which may be doc), in its doc, in its body or in that's doc.
LAYOUT = f"page {_PAGES}, doc struct<page:{_PAGES}>, body struct<page:{_PAGES},doc:struct<page:{_PAGES}>>, _corrupt_record string"
OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreSurroundingSpaces": "false", "ignoreNamespace": "true"}
PAGES = (
    "array<struct<page_number:int,width:double,height:double,words:array<struct<id:string,text:string,x0:double,top:double,x1:double,bottom:double>>,"
    "lines:array<struct<line_index:int,text:string,top:double,bottom:double,word_ids:array<string>>>>>"
)


def _or_none(c: Column) -> Column:
    """An array, empty where it is null."""
    return F.coalesce(c, F.array())


def _lines(page: Column) -> Column:
    """A page's lines: its own, those of its blocks, those of its flows and their blocks."""
    of_blocks = lambda b: F.flatten(F.transform(_or_none(b), lambda x: _or_none(x["line"])))
    of_flows = F.flatten(F.transform(_or_none(page["flow"]), lambda f: F.concat(_or_none(f["line"]), of_blocks(f["block"]))))
    return F.concat(_or_none(page["line"]), of_blocks(page["block"]), of_flows)


def _read(page: Column, number: Column) -> Column:
    name = lambda n: F.concat(F.lit("word-"), number.cast("string"), F.lit("-"), n.cast("string"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    box = lambda w: F.struct(w["_VALUE"].alias("text"), zero(w["_xMin"]).alias("x0"), zero(w["_yMin"]).alias("top"), zero(w["_xMax"]).alias("x1"), zero(w["_yMax"]).alias("bottom"))
    told = F.transform(_lines(page), lambda line: F.transform(F.filter(_or_none(line["word"]), lambda w: F.coalesce(w["_VALUE"], F.lit("")) != ""), box))
    kept = F.filter(told, lambda ws: F.size(ws) > 0)

    def whole(lines: Column) -> Column:
        words = F.transform(F.flatten(lines), lambda w, n: F.struct(name(n).alias("id"), w["text"].alias("text"), w["x0"].alias("x0"), w["top"].alias("top"), w["x1"].alias("x1"), w["bottom"].alias("bottom")))
        # The place of each line's first word, summed up once a page.
        starts = F.aggregate(lines, F.array(F.lit(0)), lambda s, ws: F.concat(s, F.array(F.element_at(s, -1) + F.size(ws))))
        line = lambda ws, i, first: F.struct(
            i.cast("int").alias("line_index"), F.array_join(F.transform(ws, lambda w: w["text"]), " ").alias("text"), F.array_min(F.transform(ws, lambda w: w["top"])).alias("top"),
            F.array_max(F.transform(ws, lambda w: w["bottom"])).alias("bottom"), F.transform(ws, lambda _, n: name(first + n)).alias("word_ids"),
        )
        told = F.transform(F.array(starts), lambda s: F.transform(lines, lambda ws, i: line(ws, i, F.get(s, i))))[0]
        return F.struct(number.cast("int").alias("page_number"), zero(page["_width"]).alias("width"), zero(page["_height"]).alias("height"), words.alias("words"), told.alias("lines"))

    return F.transform(F.array(kept), whole)[0]


def read_layout(documents: DataFrame, xml: str) -> DataFrame:
    """`documents` with status and pages in place of the XML text: of each page its number, size, words and lines.

    Pages are numbered from 1 as they come, words (those with a text that isn't all white space) over their page and lines (those with a word) from 0; a box's missing sides are 0. Tags may have name spaces. Lines may stand in
    pages, blocks or flows. A text that is null, no XML or has a side that is no number keeps its row with status error and no pages; XML without pages has status ok and none.
    What follows the root is not looked at.
    """
    parsed = documents.withColumn("_xml", F.from_xml(xml, LAYOUT, OPTIONS)).drop(xml)
    pages = F.coalesce("_xml.page", "_xml.doc.page", "_xml.body.page", "_xml.body.doc.page", F.array())
    ok = F.col("_xml").isNotNull() & F.col("_xml._corrupt_record").isNull()
    read = F.transform(pages, lambda p, i: _read(p, i + 1)).cast(PAGES)
    return parsed.select(*[F.col(c) for c in parsed.columns if c != "_xml"], F.when(ok, "ok").otherwise("error").alias("status"), F.when(ok, read).otherwise(F.array().cast(PAGES)).alias("pages"))


# The outer forms read a document once: explode() would add a filter on the size of its pages that parses it again.
def layout_words(documents: DataFrame, key: str) -> DataFrame:
    """(key, page_number, word_id, text, x0, top, x1, bottom) of read_layout()."""
    return documents.select(key, F.explode_outer("pages").alias("p")).select(key, "p.page_number", F.explode_outer("p.words").alias("w")).where("w is not null").select(key, "page_number", F.col("w.id").alias("word_id"), "w.text", "w.x0", "w.top", "w.x1", "w.bottom")


def layout_lines(documents: DataFrame, key: str) -> DataFrame:
    """(key, page_number, line_index, text, top, bottom, word_ids) of read_layout()."""
    return documents.select(key, F.explode_outer("pages").alias("p")).select(key, "p.page_number", F.explode_outer("p.lines").alias("l")).where("l is not null").select(key, "page_number", "l.*")
