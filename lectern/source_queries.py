"""Sources, resumable work and geometry bound to the test tables, each with SQL that says the same."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from pyspark.sql.window import Window

from lectern.domain_queries import _LINES, _SUPPLIERS, _cards, _documents, _level, _sha, scratch
from lectern.functions import ids, tokens
from lectern.functions.lineage import cut, written
from lectern.operators import cards, integrity, ordered
from lectern.plans import canonical, contracts, curriculum, entities, extraction, migration, resumable, runs, semantic, snapshots
from lectern.plans.snapshots import _fs
from lectern.registry import query, t
from lectern.sources import catalog, documents, files, layout, office
from lectern.streaming import ingest


# Bounding-box XML: a document for each part, a page for each line number, a line of one to three words for each item; every third document with a doctype and a body, every third broken off.
def _layouts(spark: SparkSession, d: str) -> DataFrame:
    def line(i):
        item = lambda c: i[c]
        at = lambda x0, text: F.concat(F.lit('<word xMin="'), x0.cast("string"), F.lit('" yMin="'), item("l_tax").cast("string"), F.lit('" xMax="'), (x0 + 5).cast("string"), F.lit('" yMax="'), (item("l_tax") + 2).cast("string"), F.lit('">'), text, F.lit("</word>"))
        second = F.when(item("l_linestatus") == "O", item("l_linestatus")).otherwise("")
        return F.concat(F.lit("<line>"), at(item("l_quantity"), F.concat(item("l_returnflag"), F.lit(" &amp; "), item("l_orderkey").cast("string"))), F.lit("<word/>"), at(item("l_quantity") + 10, second), F.lit("<word>é</word></line><line/>"))

    fields = ("l_orderkey", "l_quantity", "l_tax", "l_returnflag", "l_linestatus")
    pages = t(spark, d, "lineitem").groupBy("l_partkey", "l_linenumber").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("items"))
    page = F.concat(F.lit('<page width="200.5" height="'), F.col("l_linenumber").cast("string"), F.lit('"><flow><block>'), F.array_join(F.transform("items", line), ""), F.lit("</block></flow></page>"))
    documents = pages.select("l_partkey", F.struct("l_linenumber", page.alias("xml")).alias("p")).groupBy("l_partkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["xml"]), "\n").alias("pages"))
    plain = F.concat(F.lit("<doc>"), F.col("pages"), F.lit("</doc>"))
    full = F.concat(F.lit('<!DOCTYPE html><html xmlns="http://www.w3.org/1999/xhtml"><head><title/></head><body><doc>'), F.col("pages"), F.lit("</doc></body></html>"))
    return documents.select("l_partkey", F.when(F.col("l_partkey") % 3 == 0, full).when(F.col("l_partkey") % 3 == 1, plain).otherwise(F.concat(F.lit("<doc>"), F.col("pages"))).alias("xml"))


_ITEMS = """
i AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_linenumber ORDER BY l_orderkey, l_quantity, l_tax, l_returnflag, l_linestatus) - 1 AS line_index,
  dense_rank() OVER (PARTITION BY l_partkey ORDER BY l_linenumber) AS page_number FROM lineitem WHERE l_partkey % 3 < 2),
w AS (
  SELECT l_partkey, page_number, line_index, 0 AS k, l_returnflag || ' & ' || l_orderkey AS text, l_quantity AS x0, l_tax AS top, l_quantity + 5 AS x1, l_tax + 2 AS bottom FROM i
  UNION ALL SELECT l_partkey, page_number, line_index, 1, 'O', l_quantity + 10, l_tax, l_quantity + 15, l_tax + 2 FROM i WHERE l_linestatus = 'O'
  UNION ALL SELECT l_partkey, page_number, line_index, 2, 'é', 0, 0, 0, 0 FROM i
), n AS (SELECT *, 'word-' || page_number || '-' || (row_number() OVER (PARTITION BY l_partkey, page_number ORDER BY line_index, k) - 1) AS word_id FROM w)
"""


@query(f"WITH {_ITEMS} SELECT l_partkey, CAST(page_number AS INTEGER) AS page_number, word_id, text, x0, top, x1, bottom FROM n")
def layout_words(spark, d):
    return layout.layout_words(layout.read_layout(_layouts(spark, d), "xml"), "l_partkey")


@query(f"""
WITH {_ITEMS} SELECT l_partkey, CAST(page_number AS INTEGER) AS page_number, CAST(line_index AS INTEGER) AS line_index, string_agg(text, ' ' ORDER BY k) AS text, min(top) AS top, max(bottom) AS bottom,
  string_agg(word_id, ',' ORDER BY k) AS word_ids FROM n GROUP BY ALL
""")
def layout_lines(spark, d):
    return layout.layout_lines(layout.read_layout(_layouts(spark, d), "xml"), "l_partkey").withColumn("word_ids", F.array_join("word_ids", ","))


@query("""
SELECT l_partkey, CASE WHEN l_partkey % 3 = 2 THEN 'error' ELSE 'ok' END AS status, CASE WHEN l_partkey % 3 = 2 THEN 0 ELSE CAST(count(DISTINCT l_linenumber) AS INTEGER) END AS n_pages,
  CASE WHEN l_partkey % 3 < 2 THEN CAST(max(l_linenumber) AS DOUBLE) END AS height, CASE WHEN l_partkey % 3 < 2 THEN 200.5::DOUBLE END AS width FROM lineitem GROUP BY l_partkey
""")
def layout_documents(spark, d):
    read = layout.read_layout(_layouts(spark, d), "xml")
    return read.select("l_partkey", "status", F.size("pages").alias("n_pages"), F.array_max(F.transform("pages", lambda p: p["height"])).alias("height"), F.get("pages", F.lit(0))["width"].alias("width"))


# Spans against spans: orders as spans of their price, widths from a cent to the whole range; a third of all in one group.
def _spans(spark: SparkSession, d: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    width = F.when(key % 97 == 0, 200_000.0).when(key % 7 == 0, 500.0).when(key % 2 == 0, 20.0).otherwise(0.5)
    return t(spark, d, "orders").select("o_orderkey", F.when(key % 3 == 0, 0).otherwise(F.col("o_custkey") % 50 + 1).alias("grp"), price.alias("left"), (price + width).alias("right"))


@query("""
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 50 + 1 END AS grp, o_totalprice AS l,
  o_totalprice + CASE WHEN o_orderkey % 97 = 0 THEN 200000.0 WHEN o_orderkey % 7 = 0 THEN 500.0 WHEN o_orderkey % 2 = 0 THEN 20.0 ELSE 0.5 END::DOUBLE AS r FROM orders)
SELECT a.grp, a.o_orderkey, b.o_orderkey AS other, round(least(a.r, b.r) - greatest(a.l, b.l), 6) AS shared
FROM s AS a JOIN s AS b ON a.grp = b.grp AND a.o_orderkey < b.o_orderkey AND least(a.r, b.r) - greatest(a.l, b.l) > 0.1
""")
def interval_join(spark, d):
    met = ordered.own_overlaps(_spans(spark, d), "o_orderkey", ["grp"])
    # As round() to six places gives it, whose decimals would cost more than the join: what is shared is positive.
    return met.select(F.col("grp").cast("long").alias("grp"), "o_orderkey", "other", (F.floor(F.col("shared") * 1e6 + 0.5) / 1e6).alias("shared"))


@query("""
WITH b AS (SELECT p_partkey, p_retailprice AS l, p_retailprice + CASE WHEN p_partkey % 10 = 0 THEN 300.0 ELSE 0.01 * (p_partkey % 20) END::DOUBLE AS r FROM part)
SELECT p_partkey, ps.s_suppkey FROM b JOIN (SELECT s_suppkey, 900 + abs(s_acctbal) / 10 AS x FROM supplier) AS ps ON ps.x >= l - 0.15::DOUBLE AND ps.x <= r + 0.15::DOUBLE
""")
def bands_of_any_width(spark, d):
    key = F.col("p_partkey")
    bands = t(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("left"), (F.col("p_retailprice") + F.when(key % 10 == 0, 300.0).otherwise(0.01 * (key % 20))).alias("right"))
    points = t(spark, d, "supplier").select("s_suppkey", (900 + F.abs("s_acctbal") / 10).alias("x"))
    return ordered.in_bands(points, "x", bands).select("p_partkey", "s_suppkey")


# Resumable work: all orders are priced, then the results of a batch get lost and some orders change.
@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 OR o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS done_by, o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS price FROM orders WHERE o_orderkey % 5 > 0
""")
def resumed_batches(spark, d):
    root = scratch(spark)
    orders = t(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    stamped = lambda df: df.withColumn("fingerprint", F.sha2(F.col("price").cast("string"), 256))
    go = lambda df, n: resumable.run(spark, stamped(df), root, n, lambda part: part.select("o_orderkey", "price", F.lit(n).alias("done_by")), "o_orderkey", "fingerprint", batches=4, deal=F.col("o_orderkey"))
    go(orders, 1)
    fs, lost = _fs(spark, f"{root}/results/00000001-1")
    fs.delete(lost, True)
    changed = orders.withColumn("price", F.col("price") + F.when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0)).where("o_orderkey % 5 > 0")
    go(changed, 2)
    return resumable.results(spark, stamped(changed), root, "o_orderkey", "fingerprint").select("o_orderkey", "done_by", "price")


# Catalogues: the web pages get addresses in five chains, each with three cards among what the page holds; the last page of a chain leads back to its first, one chain starts at its second page.
def _catalog_pages(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("page_id")
    chain, place = key % 5, F.expr("page_id div 5")
    own = t(spark, d, "pages").select("page_id", "html", chain.alias("c"), place.alias("p"))
    ends = own.groupBy("c").agg(F.max("p").alias("last"))
    own = own.join(ends, "c")
    number = lambda i: (F.col("page_id") * 7 + i) % 60
    card = lambda i: F.concat(
        F.lit('<a class="big e-card" href="/Prog/'), number(i).cast("string"), F.lit('?b=2&amp;a='), F.col("c").cast("string"), F.lit('#x"><span class="e-card__category">'),
        F.when(number(i) % 4 == 0, "no code").otherwise(F.concat(F.lit("09.03.1"), (number(i) % 10).cast("string"), F.lit("  Field &amp; "), number(i).cast("string"))), F.lit('</span><b class="e-card__title-inner">'),
        F.when(number(i) % 3 == 0, "").otherwise(F.concat(F.lit(" Name\n of "), F.col("page_id").cast("string"))), F.lit("</b></a>"),
    )
    onward = F.concat(F.lit('<link rel="up next" href="/c'), F.col("c").cast("string"), F.lit("/p"), F.when(F.col("p") == F.col("last"), 0).otherwise(F.col("p") + 1).cast("string"), F.lit('">'))
    html = F.concat(F.coalesce("html", F.lit("")), onward, card(0), card(1), card(2), F.lit('<a class="e-card">nowhere</a>'))
    return own.select(F.concat(F.lit("https://catalog.example.com/c"), F.col("c").cast("string"), F.lit("/p"), F.col("p").cast("string")).alias("url"), html.alias("html"))


@query("""
WITH p AS (SELECT page_id, page_id % 5 AS c, page_id // 5 AS p, max(page_id // 5) OVER (PARTITION BY page_id % 5) AS last FROM pages),
o AS (SELECT *, CASE WHEN c = 3 THEN (p - 1 + last + 1) % (last + 1) ELSE p END AS place FROM p),
k AS (SELECT o.*, i, (page_id * 7 + i) % 60 AS n FROM o CROSS JOIN (SELECT unnest([0, 1, 2]) AS i)),
f AS (SELECT *, n % 4 > 0 AS coded, CASE WHEN n % 3 > 0 THEN 'Name of ' || page_id WHEN n % 4 > 0 THEN 'Field & ' || n ELSE '' END AS name FROM k),
b AS (SELECT *, row_number() OVER (PARTITION BY c, n ORDER BY place, i) AS r FROM f WHERE name <> '')
SELECT c AS catalog, 'https://catalog.example.com/Prog/' || n || '?a=' || c || '&b=2' AS source_key, name, CASE WHEN coded THEN '09.03.1' || (n % 10) ELSE '' END AS code, CASE WHEN coded THEN '09.03.1' || (n % 10) ELSE name END AS direction,
  CASE WHEN coded THEN 'Field & ' || n ELSE name END AS direction_name, 'https://catalog.example.com/c' || c || '/p' || p AS catalog_page, place + 1 AS page_number FROM b WHERE r = 1
""")
def catalog_chain(spark, d):
    pages = catalog.read_cards(_catalog_pages(spark, d), "url", "html")
    starts = spark.createDataFrame([(c, f"https://catalog.example.com/c{c}/p{int(c == 3)}") for c in range(5)], "catalog long, url string")
    return catalog.catalog_cards(cut(pages), starts).drop("category", "catalog_url")


# Documents: a file for each supplier, a DOCX with its orders' prices in a table of merged cells, or one without a table, one broken, one of another kind, a PDF without a reader, or none at all.
_W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def _docx(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(local_path, content) of (local_path, key, name, parts), one document at a time."""

    def cell(text: str, more: str = "") -> str:
        return f"<w:tc><w:tcPr>{more}</w:tcPr><w:p><w:r><w:t>{text}</w:t></w:r></w:p></w:tc>"

    def write(key: int, name: str, parts: Iterable) -> bytes:
        rows = [f'<w:tr>{cell("items of " + name, "<w:gridSpan w:val=" + chr(34) + "2" + chr(34) + "/>")}{cell("size", "<w:vMerge w:val=" + chr(34) + "restart" + chr(34) + "/>")}</w:tr>']
        rows += [f"<w:tr>{cell(str(k))}{cell('x' + str(s))}{cell('', '<w:vMerge/>')}</w:tr>" for k, s in parts]
        table = "" if key % 7 == 1 else f"<w:tbl>{''.join(rows)}</w:tbl>"
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("word/document.xml", f'<w:document xmlns:w="{_W}"><w:body><w:p><w:r><w:t>{name}</w:t><w:tab/><w:t>plan</w:t></w:r></w:p>{table}<w:p/></w:body></w:document>')
        content = out.getvalue()
        return {2: content[:60], 3: b"<!DOCTYPE html><p>", 4: b"%PDF-1.4 no reader"}.get(key % 7, content)

    for batch in batches:
        for i in range(batch.num_rows):
            at, key, name, parts = (batch.column(c)[i] for c in range(4))
            content = write(key.as_py(), name.as_py(), ((p["k"].as_py(), p["s"].as_py()) for p in parts))
            yield pa.RecordBatch.from_arrays([pa.array([at.as_py()]), pa.array([content], pa.binary())], ["local_path", "content"])


def _manifest(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s = t(spark, d, "supplier").select("s_suppkey", "s_name")
    manifest = s.select(F.concat(F.lit("doc"), "s_suppkey").alias("document_id"), F.when(F.col("s_suppkey") % 7 != 6, F.concat(F.lit("plans\\"), "s_suppkey", F.lit(".docx"))).alias("local_path"))
    parts = t(spark, d, "part").select((F.col("p_partkey") % 50).alias("s_suppkey"), F.struct(F.col("p_partkey").alias("k"), F.col("p_size").alias("s")).alias("p")).groupBy("s_suppkey").agg(F.array_sort(F.collect_list("p")).alias("parts"))
    held = s.where("s_suppkey % 7 <> 5").join(parts, "s_suppkey", "left").withColumn("parts", F.coalesce("parts", F.array().cast("array<struct<k:bigint,s:int>>")))
    held = held.select(F.concat(F.lit("plans/"), "s_suppkey", F.lit(".docx")).alias("local_path"), "s_suppkey", "s_name", "parts")
    files = held.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "local_path").mapInArrow(_docx, "local_path string, content binary")
    return manifest, files.unionByName(spark.createDataFrame([("other/file.docx", b"PK\x03\x04")], "local_path string, content binary"))


_PARTS = "(SELECT s_suppkey, s_name, (SELECT count(*) FROM part WHERE p_partkey % 50 = s_suppkey) AS n FROM supplier)"


@query(f"""
SELECT 'doc' || s_suppkey AS document_id, ['ok', 'ok_no_tables', 'error', 'invalid_source', 'error', 'missing', 'missing'][s_suppkey % 7 + 1] AS status, ['docx', 'docx', 'docx', 'html', 'pdf', 'missing', 'missing'][s_suppkey % 7 + 1] AS kind,
  CASE WHEN s_suppkey % 7 < 2 THEN 2 ELSE 0 END AS paragraph_count, CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END AS table_count, CAST(CASE WHEN s_suppkey % 7 = 0 THEN n + 1 ELSE 0 END AS INTEGER) AS row_count,
  CAST(CASE WHEN s_suppkey % 7 = 0 THEN 3 * (n + 1) ELSE 0 END AS INTEGER) AS cell_count, s_suppkey % 7 IN (5, 6) AS no_file FROM {_PARTS}
""")
def document_statuses(spark, d):
    found = documents.extract(*_manifest(spark, d))
    return found.select("document_id", "status", "kind", "paragraph_count", "table_count", "row_count", "cell_count", (F.col("source_size") == 0).alias("no_file"))


@query(f"""
WITH p AS (SELECT s_suppkey, s_name, p_partkey, p_size, CAST(row_number() OVER (PARTITION BY s_suppkey ORDER BY p_partkey) AS INTEGER) AS r FROM supplier JOIN part ON p_partkey % 50 = s_suppkey WHERE s_suppkey % 7 = 0)
SELECT 'doc' || s_suppkey AS document_id, 0 AS row_index, c AS column_index, CASE WHEN c < 2 THEN 'items of ' || s_name ELSE 'size' END AS text FROM supplier CROSS JOIN (SELECT unnest([0, 1, 2]) AS c) WHERE s_suppkey % 7 = 0
UNION ALL SELECT 'doc' || s_suppkey, r, c, CASE c WHEN 0 THEN CAST(p_partkey AS VARCHAR) WHEN 1 THEN 'x' || p_size ELSE 'size' END FROM p CROSS JOIN (SELECT unnest([0, 1, 2]) AS c)
""")
def document_grids(spark, d):
    found = documents.extract(*_manifest(spark, d))
    pages = F.transform("pages", lambda p: p.dropFields("lines"))
    return extraction.flatten(found.select("document_id", "status", pages.alias("pages"), "tables"))["cells"].select("document_id", "row_index", "column_index", "text")


# A run of three stages over orders and items, told by its manifest.
@query("""
WITH o AS (SELECT * FROM orders WHERE o_totalprice > 1000), i AS (SELECT l.* FROM lineitem AS l JOIN o ON o_orderkey = l_orderkey), s AS (SELECT o_orderkey FROM o JOIN i ON o_orderkey = l_orderkey GROUP BY 1 HAVING sum(l_quantity) > 100)
SELECT 0 AS number, 'orders' AS name, count(*) AS n_rows, CAST(CAST(max(o_totalprice) AS INTEGER) AS VARCHAR) AS largest, true AS written, true AS read FROM o
UNION ALL SELECT 1, 'items', count(*), CAST(CAST(max(l_quantity) AS INTEGER) AS VARCHAR), true, true FROM i UNION ALL SELECT 2, 'large', count(*), NULL, true, true FROM s
""")
def run_manifest_stages(spark, d):
    root = scratch(spark)
    largest = lambda c: {"largest": F.max(F.round(c).cast("int"))}
    with runs.Run(spark, root, "run-1", "orders") as run:
        orders = run.write("orders", t(spark, d, "orders").where("o_totalprice > 1000"), "orders", ["https://example.com/orders"], largest(F.col("o_totalprice")))
        items = run.write("items", t(spark, d, "lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey"), "items", ["orders"], largest(F.col("l_quantity")))
        large = items.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")).where("q > 100")
        run.write("large", large, "large", ["orders", "items"])
    told = runs.stages(spark, f"{root}/runs/run-1.json").where("status = 'succeeded'")
    written = F.exists("outputs", lambda o: o["available"] & (o["file_count"] > 0) & (o["size_bytes"] > 0))
    return told.select("number", "name", F.col("rows").alias("n_rows"), F.try_element_at("metrics", F.lit("largest")).alias("largest"), written.alias("written"), F.forall("inputs", lambda i: i["available"]).alias("read"))


# Curriculum tables with words: a table for each supplier, headings that differ (semesters missing, repeated, out of order, or none), a row for each part.
_HEADS = {0: (1, 2), 1: (1, 3), 2: (2, 1, 2), 3: ()}
_CELLS = ((0, 0.0, 5.0), (1, 5.0, 10.0), (2, 10.0, 15.0), (3, 50.0, 75.0))


def _tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    k = F.col("s_suppkey")
    own = t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("t"), k).alias("table_id"), F.concat(F.lit("d"), k).alias("document_id"))
    tables = own.select("table_id", "document_id", F.lit(1).alias("page_number"), F.lit(0).alias("ordinal"), F.lit("curriculum").alias("section"), F.lit(0.0).alias("x0"), F.lit(100.0).alias("x1"))
    weeks = (10 + k % 9).cast("string")
    heading = lambda kind: F.concat_ws(" ", *[F.concat(F.lit(f"Семестр {n} – "), (weeks if i < 2 else (k % 9).cast("string")), F.lit(" недель")) for i, n in enumerate(_HEADS[kind])])
    cell = lambda row, at, text, x0: F.struct(F.lit(row).alias("row_index"), F.lit(at).alias("column_index"), text.alias("text"), F.lit(x0).alias("x0"), F.lit(x0 + 5).alias("x1"))
    head = F.array(
        cell(0, 0, F.lit(" ШИФР"), 0.0), cell(0, 1, F.lit("Наименование\nдисциплины"), 5.0), cell(0, 2, F.when(k % 5 > 0, "Кафедра").otherwise("?"), 10.0), cell(2, 3, F.lit("Общая, з.е."), 15.0), cell(3, 4, F.lit("Общая, час"), 20.0),
        cell(0, 9, F.when(k % 4 == 0, heading(0)).when(k % 4 == 1, heading(1)).when(k % 4 == 2, heading(2)).otherwise("no semesters"), 50.0),
    )
    heads = own.select("table_id", F.explode(head).alias("h")).select("table_id", "h.*", F.array().cast("array<string>").alias("word_ids"))
    part = t(spark, d, "part").withColumn("s_suppkey", F.col("p_partkey") % 40).join(own, "s_suppkey")
    part = part.withColumn("row_index", (3 + F.row_number().over(Window.partitionBy("table_id").orderBy("p_partkey"))).cast("int"))
    p, size = F.col("p_partkey"), F.col("p_size")
    texts = [(0, p.cast("string"), 1.0, 3.0), (1, F.concat(F.lit("part"), p), 6.0, 7.0), (1, F.col("p_type"), 8.0, 9.0), (2, F.col("p_brand"), 11.0, 13.0), (3, size.cast("string"), 50.5, 51.5), (3, (size * 36).cast("string"), 55.5, 56.5), (3, F.when(p % 3 == 0, "Экз").otherwise("Зчт"), 71.0, 73.0)]
    name = lambda i: F.concat(F.lit("w"), p, F.lit("-"), F.lit(i))
    word = F.explode(F.array(*[F.struct(name(i).alias("word_id"), text.alias("text"), F.lit(a).alias("x0"), F.lit(b).alias("x1")) for i, (_, text, a, b) in enumerate(texts)])).alias("w")
    words = part.select("document_id", F.lit(1).alias("page_number"), word, F.col("row_index").cast("double").alias("top")).select("document_id", "page_number", "w.*", "top")
    box = F.explode(F.array(*[F.struct(F.lit(c).alias("column_index"), F.lit("").alias("text"), F.lit(a).alias("x0"), F.lit(b).alias("x1"), F.array(*[name(i) for i, w in enumerate(texts) if w[0] == c]).alias("word_ids")) for c, a, b in _CELLS])).alias("c")
    cells = heads.unionByName(part.select("table_id", "row_index", box).select("table_id", "row_index", "c.*"))
    return tables, cells.withColumn("cell_id", F.concat_ws("-", "table_id", "row_index", "column_index")), words


@query("""
SELECT 'd' || s_suppkey AS document_id, 0.5::DOUBLE AS start, [2, 3, 2][s_suppkey % 4 + 1] AS n_semesters, CASE WHEN s_suppkey % 4 = 2 THEN s_suppkey % 9 WHEN s_suppkey % 4 = 0 THEN 10 + s_suppkey % 9 END AS weeks_of_second,
  array_to_string(list_filter([CASE WHEN s_suppkey % 4 = 1 THEN 'missing_semesters:2' END, CASE WHEN s_suppkey % 4 = 2 THEN 'repeated_semesters:2' END, CASE WHEN s_suppkey % 4 = 2 THEN 'unordered_semesters' END,
    'missing_fields:' || CASE WHEN s_suppkey % 5 = 0 THEN 'department,' ELSE '' END || 'audited_hours,lecture_hours,seminar_hours,lab_hours,independent_or_other_hours'], lambda x: x IS NOT NULL), ' ') AS warnings
FROM supplier WHERE s_suppkey % 4 < 3
""")
def curriculum_warnings(spark, d):
    tables, cells, _ = _tables(spark, d)
    return curriculum.discover_schemas(tables, cells).select("document_id", "start", F.col("count").alias("n_semesters"), F.try_element_at("weeks", F.lit(2)).cast("long").alias("weeks_of_second"), F.array_join("warnings", " ").alias("warnings"))


_ROWS = "(SELECT *, p_partkey % 40 AS s, 3 + row_number() OVER (PARTITION BY p_partkey % 40 ORDER BY p_partkey) AS r FROM part WHERE p_partkey % 40 IN (SELECT s_suppkey FROM supplier))"


@query(f"""
SELECT 't' || s AS table_id, CAST(r AS INTEGER) AS row_index, CASE WHEN s % 4 = 3 THEN 'unresolved_schema' ELSE 'discipline' END AS row_kind, CASE WHEN s % 4 = 3 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS code,
  CASE WHEN s % 4 = 3 THEN '' ELSE 'part' || p_partkey || ' ' || p_type END AS name, CASE WHEN s % 4 = 3 OR s % 5 = 0 THEN '' ELSE p_brand END AS department FROM {_ROWS}
""")
def curriculum_word_rows(spark, d):
    tables, cells, words = _tables(spark, d)
    schemas = written(curriculum.discover_schemas(tables, cells))
    return curriculum.semantic_rows(written(curriculum.band_texts(tables, cells, words, schemas))).select("table_id", "row_index", "row_kind", "code", "name", "department")


@query(f"""
SELECT p_partkey, CAST(n AS INTEGER) AS semester, CASE WHEN n = 1 THEN CAST(p_size AS DOUBLE) END AS credits, CASE WHEN n = 1 THEN CAST(p_size * 36 AS DOUBLE) END AS hours, CASE WHEN n > 1 THEN '' WHEN p_partkey % 3 = 0 THEN 'exam' ELSE 'credit' END AS control_kinds,
  n = 1 AS active, CASE WHEN s % 4 <> 1 OR n = 3 THEN '' WHEN n = 1 THEN 'control_reassigned_by_word_start' ELSE 'control_token_removed_from_hours' END AS notes
FROM {_ROWS} CROSS JOIN (SELECT unnest([1, 2, 3]) AS n) WHERE s % 4 < 3 AND n <= [2, 3, 2][s % 4 + 1]
""")
def curriculum_word_loads(spark, d):
    tables, cells, words = _tables(spark, d)
    schemas = written(curriculum.discover_schemas(tables, cells))
    found = curriculum.disciplines(cut(curriculum.semantic_rows(written(curriculum.band_texts(tables, cells, words, schemas)))))
    loads = curriculum.semester_loads(found)
    return loads.select(F.col("code").cast("long").alias("p_partkey"), "semester", "credits", "hours", F.array_join("control_kinds", ",").alias("control_kinds"), "active", F.array_join("normalization_notes", ",").alias("notes"))


@query(f"""
WITH r AS (SELECT *, [2, 3, 2][s % 4 + 1] AS n FROM {_ROWS} WHERE s % 4 < 3),
b AS (
  SELECT s, r, p_partkey, 0 AS semester, u.f AS field, u.a, u.b FROM r CROSS JOIN (VALUES ('code', 0.0, 5.0), ('name', 5.0, 10.0), ('department', 10.0, 15.0), ('total_credits', 15.0, 20.0), ('total_hours', 20.0, 25.0)) AS u(f, a, b) WHERE u.f <> 'department' OR s % 5 > 0
  UNION ALL SELECT s, r, p_partkey, m, ['credits', 'hours', 'audited_hours', 'independent_or_other_hours', 'control'][i + 1], 50 + 50.0::DOUBLE / n * (m - 1 + i / 5.0::DOUBLE), 50 + 50.0::DOUBLE / n * (m - 1 + (i + 1) / 5.0::DOUBLE)
  FROM r CROSS JOIN (SELECT unnest([1, 2, 3]) AS m) CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS i) WHERE m <= n
), c AS (SELECT * FROM (VALUES (0, 0.0, 5.0), (1, 5.0, 10.0), (2, 10.0, 15.0), (3, 50.0, 75.0)) AS u(c, a, b)),
w AS (SELECT * FROM (VALUES (0, 2.0), (1, 6.5), (2, 8.5), (3, 12.0), (4, 51.0), (5, 56.0), (6, 72.0)) AS u(w, x))
SELECT 't' || s AS table_id, CAST(r AS INTEGER) AS row_index, CAST(semester AS INTEGER) AS semester, field,
  coalesce((SELECT string_agg('t' || s || '-' || r || '-' || c.c, ',' ORDER BY c.c) FROM c WHERE least(c.b, b.b) - greatest(c.a, b.a) > 0.1), '') AS cell_ids,
  coalesce((SELECT string_agg('w' || p_partkey || '-' || w.w, ',' ORDER BY w.w) FROM w WHERE w.x BETWEEN b.a - 0.15 AND b.b + 0.15), '') AS word_ids
FROM b WHERE cell_ids <> '' OR word_ids <> ''
""")
def curriculum_sources(spark, d):
    tables, cells, words = _tables(spark, d)
    schemas = written(curriculum.discover_schemas(tables, cells))
    return curriculum.band_sources(tables, cells, words, schemas).withColumns({c: F.array_join(c, ",") for c in ("cell_ids", "word_ids")})


# A migration: parts under old ids, replayed under new ones, twice.
@query("""
SELECT 'old-' || p_partkey AS legacy_id, 'new-' || p_partkey AS canonical_id, true AS first_changed, false AS again, (SELECT count(*) FROM part) AS n_raw FROM part WHERE p_partkey % 3 > 0
UNION ALL SELECT 'ancient-' || p_partkey, 'old-' || p_partkey, true, false, (SELECT count(*) FROM part) FROM part WHERE p_partkey % 10 = 0
UNION ALL SELECT 'told-' || p_partkey, 'new-' || p_partkey, true, false, (SELECT count(*) FROM part) FROM part WHERE p_partkey % 7 = 0
""")
def migrated_snapshot(spark, d):
    root, part = scratch(spark), t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("k"), "p_name", "p_size")
    number = F.col("k").cast("long")
    alias = lambda where, a, b: part.where(where).select(F.lit("parts").alias("entity_type"), F.concat(F.lit(a), "k").alias("legacy_id"), F.concat(F.lit(b), "k").alias("canonical_id"))
    old = part.select(F.concat(F.when(number % 3 == 0, "new-").otherwise("old-"), "k").alias("id"), "k", "p_name")
    snapshots.publish(spark, root, "run-0", {"parts": old, "aliases": alias(number % 10 == 0, "ancient-", "old-")}, keys={"aliases": None})
    go = lambda run: migration.migrate(spark, root, run, part, lambda raw: {"parts": raw.select(F.concat(F.lit("new-"), "k").alias("id"), "k", "p_name")}, {"parts": "k"}, alias(number % 7 == 0, "told-", "new-"), required=("parts",))
    first, again = go("run-1"), go("run-2")
    now = snapshots.active(spark, root)
    n_raw = spark.read.parquet(f"{now}/raw").count()
    return spark.read.parquet(f"{now}/aliases").select("legacy_id", "canonical_id", F.lit(first["changed"]).alias("first_changed"), F.lit(again["changed"] or now != first["snapshot"]).alias("again"), F.lit(n_raw).alias("n_raw"))


# Views of the current snapshot: a session sees one snapshot until it moves on; datasets that are gone lose their view.
@query("""
SELECT 'before' AS phase, o_orderstatus AS status, count(*) AS n, true AS has_parts FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'meanwhile', o_orderstatus, count(*), true FROM orders GROUP BY o_orderstatus UNION ALL SELECT 'after', o_orderstatus, count(*), false FROM orders WHERE o_totalprice > 1000 GROUP BY o_orderstatus
""")
def snapshot_views(spark, d):
    root, prefix = scratch(spark), "snapshot_views_"
    orders, part = t(spark, d, "orders").withColumnRenamed("o_orderkey", "id"), t(spark, d, "part").withColumnRenamed("p_partkey", "id")

    def seen(phase: str) -> DataFrame:
        has_parts = spark.catalog.tableExists(f"{prefix}parts")
        return cut(spark.sql(f"SELECT '{phase}' AS phase, o_orderstatus AS status, count(*) AS n FROM {prefix}orders GROUP BY o_orderstatus").withColumn("has_parts", F.lit(has_parts)))

    snapshots.publish(spark, root, "run-1", {"orders": orders, "parts": part})
    snapshots.open_views(spark, root, prefix)
    before = seen("before")
    snapshots.publish(spark, root, "run-2", {"orders": orders.where("o_totalprice > 1000"), "parts": part}, available={"orders"})
    meanwhile = seen("meanwhile")
    snapshots.open_views(spark, root, prefix)
    return before.unionByName(meanwhile).unionByName(seen("after"))


# Loads as the rows of a CSV file, read back from it.
_LOADS = f"""
l AS (SELECT *, [2, 3, 2][s % 4 + 1] AS k, 't' || s || '-' || r || '-3' AS cell FROM {_ROWS} CROSS JOIN (SELECT unnest([1, 2, 3]) AS n) WHERE s % 4 < 3 AND n <= [2, 3, 2][s % 4 + 1]),
f AS (SELECT *, CASE WHEN n = 1 THEN CAST(p_size AS VARCHAR) ELSE '' END AS c, CASE WHEN n = 1 THEN CAST(p_size * 36 AS VARCHAR) WHEN n = 2 AND k = 3 THEN token ELSE '' END AS h, CASE WHEN n = 1 AND k = 2 THEN token ELSE '' END AS x
  FROM (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN 'Экз' ELSE 'Зчт' END AS token FROM l))
"""


@query(f"""
WITH {_LOADS}
SELECT CAST(p_partkey AS VARCHAR) AS code, CAST(n AS VARCHAR) AS semester, 'd' || s AS document_id, '1' AS page_number, CAST(n = 1 AS VARCHAR) AS active, CASE WHEN n = 1 THEN p_size || '.0' ELSE '' END AS credits, CASE WHEN n = 1 THEN token ELSE '' END AS control,
  CASE WHEN n = 1 THEN '["' || token || '"]' ELSE '[]' END AS control_tokens, '{{"credits":"' || c || '","hours":"' || h || '","audited_hours":"","independent_or_other_hours":"","control":"' || x || '"}}' AS raw,
  CASE WHEN n = 1 OR (k = 3 AND n = 2) THEN '["' || cell || '"]' ELSE '[]' END AS source_cell_ids,
  CASE WHEN n = 1 THEN '["w' || p_partkey || '-4","w' || p_partkey || '-5"' || CASE WHEN k = 2 THEN ',"w' || p_partkey || '-6"]' ELSE ']' END WHEN n = 2 AND k = 3 THEN '["w' || p_partkey || '-6"]' ELSE '[]' END AS source_word_ids
FROM f
""")
def curriculum_load_files(spark, d):
    tables, cells, words = _tables(spark, d)
    schemas = written(curriculum.discover_schemas(tables, cells))
    parts = curriculum.placed(tables, cells, words, schemas)
    found = curriculum.disciplines(written(curriculum.semantic_rows(written(curriculum.band_texts(tables, cells, words, schemas, parts)))))
    at = scratch(spark)
    curriculum.write_loads(curriculum.load_rows(curriculum.semester_loads(found), curriculum.band_sources(tables, cells, words, schemas, parts=parts)), at)
    back = files.read_csv(spark, at, curriculum.LOAD_COLUMNS)
    return back.select("code", "semester", "document_id", "page_number", "active", "credits", "control", "control_tokens", "raw", "source_cell_ids", "source_word_ids")


# The semantic level written and read back.
@query(f"""
SELECT 'rows' AS dataset, count(*) AS n FROM {_ROWS} UNION ALL SELECT 'disciplines', count(*) FROM {_ROWS} WHERE s % 4 < 3
UNION ALL SELECT 'loads', CAST(sum([2, 3, 2][s % 4 + 1]) AS BIGINT) FROM {_ROWS} WHERE s % 4 < 3 UNION ALL SELECT 'schemas', count(*) FROM supplier WHERE s_suppkey % 4 < 3
""")
def semantic_dataset(spark, d):
    tables, cells, words = _tables(spark, d)
    schemas = written(curriculum.discover_schemas(tables, cells))
    rows = written(curriculum.semantic_rows(written(curriculum.band_texts(tables, cells, words, schemas))))
    found, at = written(curriculum.disciplines(rows)), scratch(spark)
    semantic.write({"rows": rows, "disciplines": found, "loads": curriculum.semester_loads(found), "schemas": schemas}, at)
    back = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("dataset"), "n") for name, df in files.read_snapshot(spark, at, ["rows", "disciplines", "loads", "schemas", "absent"]).items()]
    return back[0].unionByName(back[1]).unionByName(back[2]).unionByName(back[3])


# The eight files of cards, read back: their rows and their headers.
@query("""
WITH s AS (SELECT s_suppkey % 2 = 1 AS odd FROM supplier JOIN nation ON n_nationkey = s_nationkey), c AS (SELECT count(*) AS n, count(*) FILTER (WHERE odd) AS o FROM s)
SELECT 'majors' AS file, n AS n_rows, 'code,faculty_name,id,military,n_departments,n_prices,n_requirements,name,qualification,slug' AS header FROM c UNION ALL SELECT 'departments', n, 'about,department_key,faculty,ordinal,realized_programs,slug,title' FROM c
UNION ALL SELECT 'educational_programs', o, 'code,department,name,ordinal,places,places_raw,places_warning,plan_url,program_key,slug' FROM c UNION ALL SELECT 'entrance_subjects', 2 * n, 'is_choice,legacy_id,ordinal,point,point_raw,point_warning,slug,title' FROM c
UNION ALL SELECT 'tuition', n, 'currency,discount,discount_raw,discount_warning,ordinal,slug,study_form,term,value,value_raw,value_warning' FROM c UNION ALL SELECT 'disciplines', 2 * n + o, 'name,owner,scope,slug' FROM c
UNION ALL SELECT 'historical_passing_scores', o, 'count,count_raw,count_warning,department,ordinal,slug,year,year_raw,year_warning' FROM c
UNION ALL SELECT 'study_plan_files', o, 'id,local_path,major_code,major_id,major_name,major_slug,mime_type,plan_status,plan_url,program_code,program_id,program_name,resolved_url,sha256,size,source_url' FROM c
""")
def card_files(spark, d):
    resolved = t(spark, d, "nation").select(F.concat(F.lit("http://plan.example.com/"), "n_name").alias("plan_url"), F.lit("ok").alias("plan_status"), *[F.lit(None).cast("string").alias(c) for c in ("resolved_url", "local_path", "size", "sha256", "mime_type")])
    at, names = scratch(spark), ["majors", "departments", "educational_programs", "entrance_subjects", "tuition", "disciplines", "historical_passing_scores", "study_plan_files"]
    cards.write_dataset(_cards(spark, d), resolved, at)
    out = None
    for name in names:
        back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{at}/{name}.csv")
        one = back.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("file"), "n_rows", F.lit(",".join(back.columns)).alias("header"))
        out = one if out is None else out.unionByName(one)
    return out


# Lines of JSON, some broken off, some blank: the good ones are read.
@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 10 > 0 AND o_orderkey % 7 > 0")
def broken_lines(spark, d):
    at, orders = scratch(spark), t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    whole = F.to_json(F.struct("*"))
    orders.select(F.when(F.col("o_orderkey") % 10 == 0, F.substr(whole, F.lit(1), F.lit(9))).when(F.col("o_orderkey") % 7 == 0, "  ").otherwise(whole).alias("value")).write.text(at)
    read = files.read_jsonl(spark, at, orders.schema, bad="skip")
    return read.unionByName(files.read_jsonl(spark, f"{at}/absent", orders.schema, missing="empty"))


# Spreadsheets: one for each supplier, its parts as rows, its name in a merged column.
@F.pandas_udf(BinaryType())
def _xlsx(name: pd.Series, parts: pd.Series) -> pd.Series:
    sheet, link = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    text = lambda at, x: f'<c r="{at}" t="inlineStr"><is><t>{x}</t></is></c>'

    def write(name: str, parts: list) -> bytes:
        rows = [f'<row r="1">{text("A1", "part")}{text("B1", " size ")}{text("C1", "supplier")}</row>']
        rows += [f'<row r="{i}"><c r="A{i}"><v>{p["k"]}</v></c><c r="B{i}"><v>{p["s"]}</v></c>{text("C2", name) if i == 2 else ""}</row>' for i, p in enumerate(parts, 2)]
        merged = f'<mergeCells><mergeCell ref="C2:C{len(parts) + 1}"/></mergeCells>' if len(parts) > 1 else ""
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{sheet}" xmlns:r="{link}"><sheets><sheet name="Plan" sheetId="1" r:id="r1"/></sheets></workbook>')
            z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
            z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{sheet}"><sheetData>{"".join(rows)}</sheetData>{merged}</worksheet>')
        return out.getvalue()

    return pd.Series([write(*x) for x in zip(name, parts, strict=True)])


@query("""
SELECT s_name AS path, 'ok' AS status, CAST(1 + row_number() OVER (PARTITION BY s_suppkey ORDER BY p_partkey) AS INTEGER) AS row, CAST(p_partkey AS VARCHAR) AS part, CAST(p_size AS VARCHAR) AS size, s_name AS supplier
FROM supplier JOIN part ON p_partkey % 50 = s_suppkey
""")
def spreadsheet_rows(spark, d):
    parts = t(spark, d, "part").select((F.col("p_partkey") % 50).alias("s_suppkey"), F.struct(F.col("p_partkey").alias("k"), F.col("p_size").alias("s")).alias("p")).groupBy("s_suppkey").agg(F.array_sort(F.collect_list("p")).alias("parts"))
    sheets = t(spark, d, "supplier").join(parts, "s_suppkey").select(F.col("s_name").alias("path"), _xlsx("s_name", "parts").alias("content"))
    rows = office.xlsx_rows(sheets, "Plan")
    return rows.select("path", "status", "row", *[F.col("values")[c].alias(c) for c in ("part", "size", "supplier")])


# Identities with what distinguishes rows of one key: whole signatures.
@query("""
WITH k AS (SELECT *, l_partkey || '|' || l_linenumber AS b, sha256('{"l_returnflag":"' || l_returnflag || '","l_suppkey":"' || l_suppkey || '"}') AS sig FROM lineitem), n AS (
  SELECT *, count(*) OVER (PARTITION BY b) AS n, count(*) OVER (PARTITION BY b, sig) AS same, row_number() OVER (PARTITION BY b, sig ORDER BY l_shipdate, l_extendedprice, l_orderkey, l_quantity) AS r FROM k)
SELECT l_orderkey, l_partkey, l_linenumber, b || CASE WHEN n = 1 THEN '' WHEN same = 1 THEN '|variant:' || substr(sig, 1, 16) ELSE '|duplicate:' || r END AS source_key FROM n
""")
def source_key_signatures(spark, d):
    rows = ids.source_keys(t(spark, d, "lineitem"), ["l_partkey", "l_linenumber"], ["l_suppkey", "l_returnflag"], ["l_shipdate", "l_extendedprice", "l_orderkey", "l_quantity"])
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "source_key")


@query("""
WITH k AS (SELECT *, 'part|' || lower(p_brand) || '|' || p_size AS b, sha256('{"p_type":"' || p_type || '"}') AS sig FROM part), n AS (
  SELECT *, count(*) OVER (PARTITION BY b) AS n, count(*) OVER (PARTITION BY b, sig) AS same, row_number() OVER (PARTITION BY b, sig ORDER BY p_partkey) AS r FROM k)
SELECT p_partkey, 'shop:part:' || substr(sha1(b || CASE WHEN n = 1 THEN '' WHEN same = 1 THEN '|variant|' || sig ELSE '|duplicate|' || r END), 1, 20) AS id, 'shop:part:' || substr(sha1('part|' || p_partkey), 1, 20) AS legacy_id FROM n
""")
def variant_ids(spark, d):
    return ids.variant_ids(t(spark, d, "part"), "shop", "part", ["p_brand", "p_size"], ["p_type"], ["p_partkey"], ["p_partkey"]).select("p_partkey", "id", "legacy_id")


# Tables by their size and place, sums of metrics, checks over all rows, what an index of entities verifies, curriculum rows without a name.
@query("SELECT p_partkey, CASE WHEN 2 * p_size >= 60 THEN 'curriculum' WHEN 2 * p_size >= 25 THEN 'calendar_schedule' WHEN 2 * p_size <= 10 OR p_retailprice >= 1000 THEN 'time_budget_summary' ELSE 'other' END AS class FROM part")
def table_classes(spark, d):
    return t(spark, d, "part").select("p_partkey", tokens.table_class(F.col("p_size") * 2, F.col("p_retailprice") - 300).alias("class"))


@query("""
WITH m AS (SELECT o_custkey, count(*) AS records, count(*) FILTER (WHERE o_orderstatus = 'F') AS failures, sum(o_totalprice) / 1000 AS ms FROM orders GROUP BY 1)
SELECT CAST(sum(records) AS BIGINT) AS records, 0::BIGINT AS warnings, 0::BIGINT AS gaps, CAST(sum(failures) AS BIGINT) AS failures, round(sum(ms), 2) AS duration_ms FROM m
""")
def metric_sums(spark, d):
    metrics = t(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("records"), F.count_if(F.col("o_orderstatus") == "F").alias("failures"), (F.sum("o_totalprice") / 1000).alias("duration_ms"))
    return integrity.metric_sums(metrics).withColumn("duration_ms", F.round("duration_ms", 2))


@query("SELECT o_orderstatus AS status, bool_and(o_totalprice > 2000) AS holds FROM orders GROUP BY 1 UNION ALL SELECT 'none', true")
def checks_of_all_rows(spark, d):
    orders = t(spark, d, "orders")
    cheap = integrity.all_true(F.col("o_totalprice") > 2000).alias("holds")
    return orders.groupBy(F.col("o_orderstatus").alias("status")).agg(cheap).unionByName(orders.where("o_orderkey < 0").agg(cheap).select(F.lit("none").alias("status"), "holds"))


@query("""
SELECT true AS all_mapped, (SELECT count(*) FROM (SELECT 1 FROM part GROUP BY lower(p_name), p_brand HAVING count(DISTINCT CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END) > 1)) = 0 AS no_ambiguous_entities, true AS passed
UNION ALL SELECT true, true, true
""")
def entity_verification(spark, d):
    part = t(spark, d, "part")
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    rows = lambda c: part.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("code"), c.alias("name"), F.col("p_type").alias("department"), F.col("p_size").alias("document_id"))
    index = lambda c: integrity.entity_index(rows(c), "shop")["verification"]
    return index(name).unionByName(index(F.col("p_name")))


@query("SELECT CASE WHEN o_orderkey % 5 = 1 THEN 'named' ELSE o_orderstatus END AS name, count(*) AS n, round(sum(o_totalprice), 2) AS hours FROM orders WHERE o_orderkey % 5 NOT IN (2, 3, 4) GROUP BY 1")
def curriculum_names(spark, d):
    k, status = F.col("o_orderkey") % 5, F.col("o_orderstatus")
    text = lambda x: F.lit(x).cast("string")
    rows = t(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("curriculum_key"), F.col("o_orderkey").cast("string").alias("code"), F.when(k == 0, status).when(k == 2, "\t \u00a0").when(k == 3, "").alias("discipline"), F.when(k == 1, " named ").when(k == 4, "\n").otherwise("other").alias("name"), text("").alias("department"),
        text("").alias("section_path"), text("1").alias("semester"), F.col("o_totalprice").cast("double").alias("total_hours"), F.lit(None).cast("double").alias("credits"), F.lit(None).cast("map<string,double>").alias("components"), F.lit(None).cast(canonical.LOADS).alias("semester_loads"),
        F.struct(F.lit("https://example.com").alias("source_url"), F.col("o_orderkey").cast("string").alias("source_key")).alias("provenance"), "o_orderkey",
    )
    found = canonical.curricula(rows, "shop", ["o_orderkey"])["disciplines"]
    return found.groupBy("name").agg(F.count("*").alias("n"), F.round(F.sum("total_hours"), 2).alias("hours"))


# Reconciliation with examples: two declared totals an order, what is off and by how much.
_TOTALS = """
(SELECT o_orderkey, coalesce(q, 0) AS q, coalesce(n, 0) AS n, coalesce(q, 0) - CASE o_orderkey % 3 WHEN 0 THEN coalesce(q, 0) + 0.005 WHEN 1 THEN coalesce(q, 0) + 7 ELSE 1 END::DOUBLE AS dq, CASE WHEN o_orderkey % 2 = 0 THEN coalesce(n, 0) - 3.0::DOUBLE END AS dn
FROM orders LEFT JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS DOUBLE) AS q, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)
"""


def _reconciled(spark: SparkSession, d: str) -> DataFrame:
    lines, k = t(spark, d, "lineitem"), F.col("o_orderkey")
    sums = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").cast("double").alias("x"))
    quantity = F.coalesce("x", F.lit(0.0))
    orders = t(spark, d, "orders").join(sums, k == F.col("l_orderkey"), "left").select("o_orderkey", F.when(k % 3 == 0, quantity + 0.005).when(k % 3 == 1, quantity + 7).otherwise(1.0).alias("hours"), F.when(k % 2 == 0, 3.0).alias("credits"))
    return integrity.reconcile(orders, "o_orderkey", lines, "l_orderkey", {"hours": ("hours", F.col("l_quantity").cast("double")), "credits": ("credits", F.lit(1.0))}, F.col("l_quantity") > 0)


@query(f"""
SELECT o_orderkey, CASE WHEN n = 0 THEN 'unallocated' ELSE 'mismatch' END AS class, CASE WHEN abs(dq) > 0.01 THEN round(dq, 3) END AS hours, CASE WHEN abs(dn) > 0.01 THEN dn END AS credits
FROM {_TOTALS} WHERE abs(dq) > 0.01 OR abs(dn) > 0.01 ORDER BY n > 0, o_orderkey LIMIT 20
""")
def reconcile_examples(spark, d):
    found = integrity.reconciliation_examples(_reconciled(spark, d), ["hours", "credits"], ["o_orderkey"])
    told = lambda m: F.round(F.try_element_at("differences", F.lit(m)), 3).alias(m)
    return found.select("o_orderkey", "class", told("hours"), told("credits"))


@query(f"""
SELECT class, off, count(*) AS n FROM (SELECT CASE WHEN abs(dq) <= 0.01 AND coalesce(abs(dn), 0) <= 0.01 THEN 'exact' WHEN n = 0 THEN 'unallocated' ELSE 'mismatch' END AS class,
  array_to_string(list_filter([CASE WHEN abs(dn) > 0.01 THEN 'credits' END, CASE WHEN abs(dq) > 0.01 THEN 'hours' END], lambda x: x IS NOT NULL), ',') AS off FROM {_TOTALS}) GROUP BY ALL
""")
def reconcile_differences(spark, d):
    found = _reconciled(spark, d)
    off = F.array_join(F.array_sort(F.map_keys(integrity.differences(found, ["hours", "credits"]))), ",")
    return found.select("class", off.alias("off")).groupBy("class", "off").agg(F.count("*").alias("n"))


@query("""
SELECT p_name, count(DISTINCT p_brand) AS n_names, array_to_string(list_sort(list(DISTINCT p_brand))[1:20], ',') AS names, array_to_string(list_sort(list(DISTINCT p_partkey))[1:20], ',') AS ids FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1
""")
def code_collision_ids(spark, d):
    found = integrity.code_collisions(t(spark, d, "part"), "p_name", "p_brand", identity="p_partkey")
    return found.select("p_name", "n_names", F.array_join("names", ",").alias("names"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(f"""
WITH r AS (SELECT *, 'plan:table:' || substr(sha1('table|' || l_orderkey || '|0'), 1, 20) AS tb FROM {_LINES})
SELECT CAST(l_orderkey AS VARCHAR) AS document_id, CAST(i AS INTEGER) AS row_index, 'plan:cell:' || substr(sha1('cell|' || tb || '|' || i || '|0'), 1, 20) || ',plan:cell:' || substr(sha1('cell|' || tb || '|' || i || '|1'), 1, 20) AS cell_ids FROM r
""")
def extracted_row_cells(spark, d):
    return extraction.rows_with_cells(_documents(spark, d)).select("document_id", "row_index", F.array_join("cell_ids", ",").alias("cell_ids"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 30 DAY")
def unexpired_entries(spark, d):
    return snapshots.unexpired(t(spark, d, "lineitem"), "l_shipdate", 30 * 86400, F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")).select("l_orderkey", "l_linenumber", "l_partkey")


# The semantic level in whole rows.
def _entities(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    disciplines, loads = _level(spark, d)
    aliases = disciplines.select(F.col("id").alias("source_id"), F.col("name").alias("entity_id"))
    known = t(spark, d, "customer").where("c_custkey % 4 > 0").select(F.col("c_custkey").cast("string").alias("document_id"), F.concat(F.lit("https://example.com/"), "c_custkey").alias("source_url"))
    return semantic.objects_and_links(disciplines, loads, aliases, known)


_LOAD_ID = "l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey || ':' || CAST(l_extendedprice AS VARCHAR)"


@query(f"""
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, 'discipline' AS type, o_custkey AS c FROM orders UNION ALL SELECT {_LOAD_ID}, 'semester_load', o_custkey FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
  UNION ALL SELECT o_orderpriority, 'discipline_entity', arg_min(o_custkey, CAST(o_orderkey AS VARCHAR)) FROM orders GROUP BY 1)
SELECT id, type, CAST(c AS VARCHAR) AS document_id, CASE WHEN c % 4 > 0 AND c IN (SELECT c_custkey FROM customer) THEN 'https://example.com/' || c END AS source_url FROM o
""")
def semantic_objects(spark, d):
    return _entities(spark, d)[0]


@query(f"SELECT {_LOAD_ID} AS source_id, 'load_of' AS relation, CAST(l_orderkey AS VARCHAR) AS target_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'resolved_to', o_orderpriority FROM orders")
def semantic_links(spark, d):
    return _entities(spark, d)[1]


@query("""
WITH l AS (SELECT l_orderkey, string_agg(l_linenumber || ':' || CAST(CAST(l_quantity AS DOUBLE) AS VARCHAR) || ':1.0', ';' ORDER BY l_linenumber, l_quantity) AS loads FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS source_key, CAST(o_custkey AS VARCHAR) AS document_id, o_orderstatus AS code, o_orderpriority AS name, 36.0::DOUBLE AS total_hours, coalesce(loads, '') AS loads,
  array_to_string(list_filter([CASE WHEN o_custkey % 2 > 0 THEN 'independent_or_other=1.0' END, CASE WHEN o_orderkey % 2 > 0 THEN 'lecture=1.0' END, CASE WHEN o_orderkey % 3 > 0 THEN 'seminar=' || (o_orderkey % 3) || '.0' END], lambda x: x IS NOT NULL), ',') AS components
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey
""")
def semantic_source_contents(spark, d):
    rows = semantic.source_rows(*_level(spark, d))
    load = lambda x: F.concat_ws(":", x["semester"].cast("string"), x["hours"].cast("string"), x["credits"].cast("string"))
    parts = F.array_sort(F.transform(F.map_entries("components"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))))
    return rows.select("source_key", "document_id", "code", "name", "total_hours", F.array_join(F.transform("semester_loads", load), ";").alias("loads"), F.array_join(parts, ",").alias("components"))


@query(f"""
SELECT 'card:study-plan:' || substr(sha1('study-plan|card:major:' || substr(sha1('major|' || lower(s_name)), 1, 20) || '|p' || k || '|http://plan.example.com/' || n_name), 1, 20) AS id, 'card:major:' || substr(sha1('major|' || lower(s_name)), 1, 20) AS major_id, 'p' || k AS program_id,
  'http://plan.example.com/' || n_name AS source_url, CASE WHEN s_nationkey % 2 = 0 THEN 'files/' || n_name ELSE NULL END AS local_path, CASE WHEN s_nationkey % 2 = 0 THEN sha256(n_name) END AS sha256, CASE WHEN s_nationkey % 2 = 0 THEN 'application/pdf' END AS mime_type,
  CASE WHEN s_nationkey % 2 = 0 THEN 'https://files.example.com/' || n_name END AS resolved_url, CASE WHEN s_nationkey % 2 = 0 THEN 'ok' ELSE 'error' END AS plan_status FROM {_SUPPLIERS} WHERE odd
""")
def plan_manifest_files(spark, d):
    n = F.col("n_name")
    resolved = t(spark, d, "nation").where("n_nationkey % 2 = 0").select(
        F.concat(F.lit("http://plan.example.com/"), n).alias("plan_url"), F.lit("ok").alias("plan_status"), F.concat(F.lit("https://files.example.com/"), n).alias("resolved_url"), F.concat(F.lit("files/"), n).alias("local_path"), F.lit(1).alias("size"),
        F.sha2(n, 256).alias("sha256"), F.lit("application/pdf").alias("mime_type"),
    )
    return cards.plan_manifest(_cards(spark, d), resolved).select("id", "major_id", "program_id", "source_url", "local_path", "sha256", "mime_type", "resolved_url", "plan_status")


# Typed entities: programs with a department that isn't published, tuition with prices as decimals, loads of lines.
@query(f"""
SELECT {_sha("program", "p_partkey")} AS id, p_name AS name, '' AS code, '' AS description, {_sha("study_direction", "lower(p_type)")} AS study_direction_id, '' AS department_id, '{{"department_key":"' || p_brand || '"}}' AS unresolved, 'published' AS name_status, 'not_published' AS code_status FROM part
""")
def entity_programs(spark, d):
    source = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("source_key"), F.col("p_name").alias("name"), F.col("p_type").alias("study_direction_key"), F.col("p_brand").alias("department_key"))
    rows = entities.project("program", source, "Shop", {"programs": True, "departments": False})
    meta = lambda c: F.element_at("field_meta", F.lit(c))["status"]
    open_ = F.element_at(F.element_at("extensions", F.lit("Shop")), F.lit("unresolved_references"))
    return rows.select("id", "name", "code", "description", "study_direction_id", "department_id", open_.alias("unresolved"), meta("name").alias("name_status"), meta("code").alias("code_status"))


@query(f"""
SELECT {_sha("tuition_option", "o_orderkey")} AS id, o_orderstatus AS study_form, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey AS DOUBLE) + 0.25 END AS value, CASE WHEN o_orderkey % 3 > 0 THEN 'published' ELSE 'not_published' END AS status,
  CASE WHEN o_custkey % 2 = 0 THEN '' ELSE {_sha("program", "o_custkey")} END AS program_id, '' AS study_direction_id FROM orders
""")
def entity_tuition(spark, d):
    k = F.col("o_orderkey")
    value = F.when(k % 3 == 0, "on request").when(k % 3 == 1, F.concat(F.lit(" "), k, F.lit(".25\n"))).otherwise(F.concat(k, F.lit(".2500")))
    source = t(spark, d, "orders").select(k.cast("string").alias("source_key"), F.col("o_orderstatus").alias("study_form"), value.alias("value"), F.when(F.col("o_custkey") % 2 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("program_key"))
    rows = entities.project("tuition_option", source, "Shop")
    return rows.select("id", "study_form", F.col("value").cast("double").alias("value"), F.element_at("field_meta", F.lit("value"))["status"].alias("status"), "program_id", "study_direction_id")


@query(f"""
SELECT {_sha("semester_load", "l_orderkey || '|' || l_linenumber")} AS id, {_sha("discipline", "l_orderkey")} AS discipline_id, {_sha("semester", "l_linenumber")} AS semester_id, '' AS curriculum_id, CAST(l_quantity AS DOUBLE) AS hours, NULL::DOUBLE AS credits FROM lineitem
""")
def entity_loads(spark, d):
    source = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("discipline_key"), F.col("l_linenumber").alias("semester"), F.col("l_quantity").cast("double").alias("hours"))
    return entities.project("semester_load", source, "Shop").select("id", "discipline_id", "semester_id", "curriculum_id", "hours", "credits")


@query("SELECT o_orderkey, o_orderkey % 4 IN (0, 1) AS located, o_orderkey % 3 = 0 AS traced FROM orders")
def provenance_predicates(spark, d):
    k = F.col("o_orderkey")
    observation = lambda page, file, raw: F.struct(page.alias("source_page"), F.lit("").alias("list_api"), F.lit(None).cast("string").alias("detail_api"), file.alias("detail_page"), raw.alias("raw_snapshot_path"))
    none = F.lit(None).cast("string")
    seen = F.array(observation(F.lit("not an address"), F.lit("file:"), F.lit("")), observation(F.when(k % 4 == 0, " HTTPS://h.example/x").otherwise("https:///x"), F.when(k % 4 == 1, F.concat(F.lit("file:///data/"), k)).otherwise(none), F.when(k % 3 == 0, F.concat(F.lit("raw/"), k)).otherwise(none)))
    return t(spark, d, "orders").select("o_orderkey", contracts.has_locator(seen).alias("located"), contracts.has_lineage(seen).alias("traced"))


# Streams: events come in two deliveries, each taken by a run that goes on from the checkpoint of the one before.
def _streamed(spark: SparkSession, d: str, plan, batch, mode: str) -> DataFrame:
    at, events = scratch(spark), t(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    for part in range(2):
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{at}/in")
        ingest.run_once(plan(ingest.new_rows(spark, f"{at}/in", events.schema)), f"{at}/state", batch(f"{at}/out"), mode).awaitTermination()
    return spark.read.parquet(f"{at}/out")


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def streamed_counts(spark, d):
    return _streamed(spark, d, lambda s: ingest.windowed_counts(s, "ts", "1 hour", "1 hour", "event_type"), ingest.keep_latest, "complete").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def streamed_first_events(spark, d):
    first = lambda s: ingest.first_per_key(s, ["user_id", "event_type"], "ts", "1000 days").select("user_id", "event_type")
    return _streamed(spark, d, first, ingest.keep_batches, "append").select("user_id", "event_type")
