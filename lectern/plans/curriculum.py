"""From the cells and words of curriculum tables to rows, disciplines and semester loads.

tables: table_id, document_id, page_number, ordinal, section, x0, x1 (the table's box, may be null).
cells: table_id, row_index, column_index, cell_id, text, x0, x1, word_ids (array).
words: document_id, page_number, word_id, text, x0, x1, top.

Rows of a document are taken in the order (ordinal of the table, row_index). Everything is keyed by document, so it is joins and windows within documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.ids import legacy_id
from lectern.functions.lineage import written
from lectern.functions.numbers import first_number, overlap
from lectern.functions.text import clean
from lectern.functions.tokens import CONTROL_PATTERN, control_kinds, control_tokens, part_type, row_kind, semester_headers
from lectern.operators.ordered import carry_forward, first_present, gaps, section_path, steps_back

HEADER_ROWS = 4
SLACK = 0.15
BANDS = "array<struct<semester:int,field:string,left:double,right:double>>"
SEMESTER_FIELDS = ("credits", "hours", "audited_hours", "independent_or_other_hours", "control")
#: Which heading names a field: row (0; or 2, else 3) and test (fixed values).
HEADINGS = {
    "code": (0, "= 'шифр'"),
    "name": (0, "like '%наименование%'"),
    "department": (0, "= 'кафедра'"),
    "total_credits": (2, "like '%общая, з.е.%'"),
    "total_hours": (2, "like '%общая, час%'"),
    "audited_hours": (2, "like '%аудит%час%' or h like '%час%аудит%'"),
    "lecture_hours": (2, "= 'лек'"),
    "seminar_hours": (2, "= 'сем'"),
    "lab_hours": (2, "= 'лаб'"),
    "independent_or_other_hours": (2, "= 'сам' or h like '%иные%'"),
}


def _clamped(x: Column, left: Column, width: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - left) / width))


def discover_schemas(tables: DataFrame, cells: DataFrame) -> DataFrame:
    """(document_id, start, count, weeks, spans, warnings): of each document the first table whose heading names semesters. start is where they begin (0..1), weeks a map from
    semester (of repeated ones the last in order), spans a map from field to (left, right) in 0..1. warnings tell of semesters that are missing, repeated or out of order, and of fields without a heading."""
    ours = tables.where("section = 'curriculum'").select("table_id", "document_id", "ordinal", F.col("x0").alias("t0"), F.col("x1").alias("t1"))
    head = cells.where(F.col("row_index") < HEADER_ROWS).select("table_id", "row_index", "text", "x0", "x1").join(ours, "table_id").withColumn("h", F.lower(clean(F.col("text"))))
    head = written(head)  # few rows, read six times
    box = head.groupBy("table_id").agg(
        F.coalesce(F.first("t0"), F.min("x0"), F.lit(0.0)).alias("left"), F.coalesce(F.first("t1"), F.max("x1"), F.lit(1.0)).alias("right")
    ).select("table_id", "left", F.greatest(F.col("right") - F.col("left"), F.lit(1.0)).alias("width"))
    head = head.join(box, "table_id")
    named = head.where("row_index = 0 and x0 is not null").withColumn("headers", semester_headers(F.col("h"))).where("size(headers) > 0")
    headers = named.select("table_id", "x0", "left", "width", F.posexplode("headers").alias("place", "s")).select("table_id", "x0", "left", "width", "place", "s.number", "s.weeks")
    weeks = headers.groupBy("table_id", "number").agg(F.max_by("weeks", F.struct("x0", "place")).alias("weeks")).groupBy("table_id").agg(F.map_from_entries(F.collect_list(F.struct("number", "weeks"))).alias("weeks"))
    semesters = headers.groupBy("table_id").agg(_clamped(F.min("x0"), F.first("left"), F.first("width")).alias("start"), F.max("number").alias("count")).join(weeks, "table_id")
    run = F.when(F.col("from") == F.col("to"), F.col("from").cast("string")).otherwise(F.concat_ws("-", "from", "to"))
    missing = gaps(headers, ["table_id"], "number").groupBy("table_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("from", run.alias("run")))), lambda x: x["run"]), ",").alias("missing"))
    odd = steps_back(headers, ["table_id"], ["x0", "place"], "number").join(missing, "table_id", "left")
    tests = F.array(*[F.when(F.expr(f"(row_index = {row}{' or row_index = 3' if row else ''}) and (h {test})"), F.lit(name)) for name, (row, test) in HEADINGS.items()])
    span = F.struct(_clamped(F.col("x0"), F.col("left"), F.col("width")).alias("left"), _clamped(F.col("x1"), F.col("left"), F.col("width")).alias("right"))
    found = head.where("x0 is not null").select("table_id", "row_index", "x0", span.alias("span"), F.explode(F.array_compact(tests)).alias("field"))
    best = found.groupBy("table_id", "field").agg(F.min_by("span", F.struct("row_index", "x0")).alias("span"))
    spans = best.groupBy("table_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "span"))).alias("spans"))
    unnamed = F.array_except(F.array(*map(F.lit, HEADINGS)), F.coalesce(F.map_keys("spans"), F.array().cast("array<string>")))
    told = [
        F.when(F.col("missing").isNotNull(), F.concat(F.lit("missing_semesters:"), "missing")), F.when(F.size("repeated") > 0, F.concat(F.lit("repeated_semesters:"), F.array_join(F.col("repeated").cast("array<string>"), ","))),
        F.when(F.col("unordered"), F.lit("unordered_semesters")), F.when(F.size(unnamed) > 0, F.concat(F.lit("missing_fields:"), F.array_join(unnamed, ","))),
    ]
    whole = ours.join(semesters, "table_id").join(odd, "table_id").join(spans, "table_id", "left").withColumn("warnings", F.array_compact(F.array(*told)))
    candidates = whole.select("document_id", "ordinal", F.struct("start", "count", "weeks", "spans", "warnings").alias("schema"))
    return first_present(candidates, ["document_id"], ["ordinal"], "schema").select("document_id", "schema.*")


def _bands(schemas: DataFrame) -> DataFrame:
    """(document_id, count, weeks, bands): bands lists (semester, field, left, right) in 0..1 for each base field (semester 0) and each field of each semester."""
    band = lambda semester, field, left, right: F.struct(semester.alias("semester"), field.alias("field"), left.alias("left"), right.alias("right"))
    base = F.transform(F.map_entries("spans"), lambda e: band(F.lit(0), e["key"], e["value"]["left"], e["value"]["right"]))
    width, parts = (1 - F.col("start")) / F.col("count"), len(SEMESTER_FIELDS)

    def fields(semester: Column) -> Column:
        lefts = [F.col("start") + width * (semester - 1 + F.lit(i) / parts) for i in range(parts)]
        return F.array(*[band(semester, F.lit(field), left, left + width / parts) for field, left in zip(SEMESTER_FIELDS, lefts, strict=True)])

    none = F.array().cast(BANDS)
    each = F.flatten(F.transform(F.sequence(F.lit(1), "count"), fields))
    return schemas.select("document_id", "count", "weeks", F.concat(F.coalesce(base, none), F.coalesce(each, none)).alias("bands"))


def placed(tables: DataFrame, cells: DataFrame, words: DataFrame, schemas: DataFrame) -> DataFrame:
    """(table_id, row_index, document_id, page_number, ordinal, cell_ids, cells, words, bands, count, weeks): each data row with its cells by column, its words from the top and the left, and its document's
    bands where they lie in the row. These are lists of one row of a table, so band_texts() and band_sources() need no joins. Written once, as both read it."""
    ours = tables.where("section = 'curriculum'").select("table_id", "document_id", "page_number", "ordinal", F.col("x0").alias("t0"), F.col("x1").alias("t1"))
    own = cells.select("table_id", "row_index", "column_index", "cell_id", "text", "x0", "x1", "word_ids")
    key, page = ["table_id", "row_index"], ["document_id", "page_number"]
    rows = written(own.where(F.col("row_index") >= HEADER_ROWS).join(ours, "table_id").groupBy(*key, *page, "ordinal").agg(
        F.coalesce(F.first("t0"), F.min("x0"), F.lit(0.0)).alias("a"), F.coalesce(F.first("t1"), F.max("x1"), F.lit(1.0)).alias("b"),
        F.transform(F.array_sort(F.collect_list(F.struct("column_index", "cell_id"))), lambda c: c["cell_id"]).alias("cell_ids"),
        F.array_sort(F.collect_list(F.struct("column_index", "text", "x0", "x1", "cell_id"))).alias("cells"), F.array_distinct(F.flatten(F.collect_list("word_ids"))).alias("word_ids"),
    ))
    named = rows.select(*key, *page, F.explode("word_ids").alias("word_id")).join(words.dropDuplicates([*page, "word_id"]), [*page, "word_id"])
    found = named.groupBy(*key, *page).agg(F.array_sort(F.collect_list(F.struct("top", "x0", "word_id", "text", "x1"))).alias("words"))
    whole = rows.join(found, [*key, *page], "left").join(_bands(schemas), "document_id", "left")
    a, width = F.col("a"), F.greatest(F.col("b") - F.col("a"), F.lit(1.0))
    bands = F.transform(F.coalesce("bands", F.array().cast(BANDS)), lambda b: b.withField("left", a + b["left"] * width).withField("right", a + b["right"] * width))
    words_there = F.coalesce("words", F.array().cast("array<struct<top:double,x0:double,word_id:string,text:string,x1:double>>"))
    return written(whole.select(*key, *page, "ordinal", "cell_ids", "cells", words_there.alias("words"), bands.alias("bands"), "count", "weeks"))


def _inside(thing: Column, band: Column) -> Column:
    """Whether a word's or a cell's middle lies in a band within the slack."""
    middle = (thing["x0"] + thing["x1"]) / 2
    return (middle >= band["left"] - SLACK) & (middle <= band["right"] + SLACK)


def band_texts(tables: DataFrame, cells: DataFrame, words: DataFrame, schemas: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """(table_id, row_index, document_id, ordinal, page_number, base, bands, cell_ids, control): per row a map from base field to its text, one from
    semester to a map of its fields' texts, and (semester, token) of control words by their left edge.

    A word belongs to every band that holds its middle within the slack. Cell texts stand in only for rows without words. `parts`: placed() of the same tables, if it is there.
    """
    rows = placed(tables, cells, words, schemas) if parts is None else parts
    has_words = F.size("words") > 0
    by_words = lambda b: F.filter("words", lambda w: _inside(w, b))
    by_cells = lambda b: F.filter("cells", lambda c: c["x0"].isNotNull() & _inside(c, b) & (clean(c["text"]) != ""))
    text_of = lambda things: F.transform(things, lambda x: x["text"])
    met = F.transform("bands", lambda b: F.struct(b["semester"].alias("semester"), b["field"].alias("field"), F.when(has_words, text_of(by_words(b))).otherwise(text_of(by_cells(b))).alias("texts")))
    texts = F.transform(F.filter(met, lambda m: F.size(m["texts"]) > 0), lambda m: F.struct(m["semester"].alias("semester"), m["field"].alias("field"), clean(F.array_join(m["texts"], " ")).alias("text")))
    fields = lambda semester: F.map_from_entries(F.transform(F.filter("_texts", lambda t: t["semester"] == semester), lambda t: F.struct(t["field"], t["text"])))
    semesters = F.array_distinct(F.transform(F.filter("_texts", lambda t: t["semester"] > 0), lambda t: t["semester"]))
    begin = F.get(F.filter("bands", lambda b: (b["semester"] == 1) & (b["field"] == "credits")), F.lit(0))["left"]

    def nearest(x0: Column) -> Column:
        away = lambda b: F.when((x0 >= b["left"]) & (x0 <= b["right"]), 0.0).otherwise(F.least(F.abs(x0 - b["left"]), F.abs(x0 - b["right"])))
        return F.array_min(F.transform(F.filter("bands", lambda b: b["field"] == "control"), lambda b: F.struct(away(b).alias("d"), b["semester"].alias("semester"))))["semester"]

    told = F.filter(F.transform("words", lambda w: F.struct(w["top"].alias("top"), w["x0"].alias("x0"), control_tokens(w["text"]).alias("tokens"))), lambda w: (F.size(w["tokens"]) > 0) & (w["x0"] >= begin - 1.0))
    control = F.filter(F.transform(told, lambda w: F.struct(nearest(w["x0"]).alias("semester"), w["top"].alias("top"), w["x0"].alias("x0"), w["tokens"].alias("tokens"))), lambda w: w["semester"].isNotNull())
    some = lambda c, made: F.when(F.size(c) > 0, made)
    made = rows.withColumns({"_texts": texts, "_control": control, "has_words": has_words}).drop("bands").withColumn("_semesters", semesters)
    return made.select(
        "table_id", "row_index", "document_id", "page_number", "ordinal", "cell_ids", F.when(F.exists("_texts", lambda t: t["semester"] == 0), fields(F.lit(0))).alias("base"),
        some("_semesters", F.map_from_entries(F.transform("_semesters", lambda n: F.struct(n, fields(n))))).alias("bands"), some("_control", F.array_sort("_control")).alias("control"), "has_words", "count", "weeks",
    )


def semantic_rows(texts: DataFrame) -> DataFrame:
    """Rows with row_kind, code, name, department, part_type, section_path (joined by " > "), workload and class hours, in document order. Rows of a document
    without a schema are unresolved_schema."""
    field = lambda name: clean(F.element_at("base", F.lit(name)))
    known = F.col("count").isNotNull()
    named = texts.withColumns({c: F.when(known, field(c)).otherwise("") for c in ("code", "name", "department")})
    named = named.withColumn("row_kind", F.when(known, row_kind(F.col("code"), F.col("name"))).otherwise("unresolved_schema"))
    group = F.col("row_kind").isin("cycle", "mandatory_group", "elective_group", "section")
    order = ["ordinal", "row_index"]
    pathed = section_path(named, ["document_id"], order, F.col("name"), group)
    own = part_type(F.col("name"))
    carried = carry_forward(pathed, ["document_id"], order, own, F.when(F.col("row_kind").isin("mandatory_group", "elective_group"), own), "unknown", "part_type")
    numbers = {c: first_number(F.element_at("base", F.lit(c))) for c in HEADINGS if c.endswith(("credits", "hours"))}
    return carried.withColumns(numbers)


def disciplines(rows: DataFrame, scope: str = "plan") -> DataFrame:
    """Discipline rows with discipline_id."""
    parts = [F.col(c) for c in ("table_id", "code", "name", "department", "part_type", "section_path")]
    return rows.where("row_kind = 'discipline'").withColumn("discipline_id", legacy_id(scope, "discipline", *parts))


def _without_tokens(c: Column) -> Column:
    return clean(F.regexp_replace(c, CONTROL_PATTERN, " "))


def semester_loads(found: DataFrame, scope: str = "plan") -> DataFrame:
    """A row for each discipline and semester: numbers of its bands (without control tokens), control tokens by the words' left edges, what they mean, whether anything
    (active) or any number (has_numeric_load) is there, and notes on what was moved."""
    each = found.withColumn("semester", F.explode(F.sequence(F.lit(1), "count"))).withColumn("raw", F.element_at("bands", F.col("semester")))
    # Texts and what is left of them without tokens are columns, so that they are made once.
    each = each.withColumns({f"_raw_{f}": F.coalesce(F.element_at("raw", F.lit(f)), F.lit("")) for f in SEMESTER_FIELDS})
    each = each.withColumns({f"_bare_{f}": _without_tokens(F.col(f"_raw_{f}")) for f in SEMESTER_FIELDS})
    raw, bare = ({f: F.col(f"_{kind}_{f}") for f in SEMESTER_FIELDS} for kind in ("raw", "bare"))
    numeric = SEMESTER_FIELDS[:-1]
    none = F.array().cast("array<string>")
    words = F.flatten(F.transform(F.filter(F.coalesce("control", F.array().cast("array<struct<semester:int,top:double,x0:double,tokens:array<string>>>")), lambda w: w["semester"] == F.col("semester")), lambda w: w["tokens"]))
    each = each.withColumn("assigned", control_tokens(F.array_join(words, " ")))
    told = F.when(F.col("has_words"), clean(F.concat_ws(" ", F.nullif(bare["control"], F.lit("")), F.array_join("assigned", " ")))).otherwise(raw["control"])
    low = lambda a: F.array_sort(F.transform(a, F.lower))
    in_numbers = F.array_join(F.array(*[raw[f] for f in numeric]), " ")
    moved = (F.size("assigned") > 0) & ((low(control_tokens(raw["control"])) != low(F.col("assigned"))) | (F.size(control_tokens(in_numbers)) > 0))
    notes = F.concat(
        F.array_compact(F.array(*[F.when(bare[f] != raw[f], F.lit(f"control_token_removed_from_{f}")) for f in numeric])),
        F.when(moved, F.array(F.lit("control_reassigned_by_word_start"))).otherwise(none),
    )
    out = each.withColumns({"told": told, "notes": notes}).withColumn("told_tokens", control_tokens(F.col("told"))).withColumns({f: first_number(bare[f]) for f in numeric})
    any_number, any_text = F.lit(False), F.col("told") != ""
    for f in numeric:
        any_number, any_text = any_number | F.col(f).isNotNull(), any_text | (bare[f] != "")
    return out.select(
        legacy_id(scope, "semester_load", F.col("discipline_id"), F.col("semester")).alias("load_id"), "discipline_id", "document_id", "table_id", "row_index", "code", "name", "semester",
        F.element_at("weeks", F.col("semester")).alias("weeks"), any_text.alias("active"), any_number.alias("has_numeric_load"), *numeric, F.col("told").alias("control"),
        F.col("told_tokens").alias("control_tokens"), control_kinds(F.col("told_tokens")).alias("control_kinds"), F.col("notes").alias("normalization_notes"),
        "page_number", legacy_id(scope, "row", F.col("table_id"), F.col("row_index")).alias("source_row_id"), F.struct(*[raw[f].alias(f) for f in SEMESTER_FIELDS]).alias("raw"),
    )


#: The columns of loads in a CSV file, in order (fixed values).
LOAD_COLUMNS = (
    "id", "discipline_id", "document_id", "table_id", "page_number", "row_index", "source_row_id", "code", "name", "semester", "weeks", "active", "has_numeric_load", "credits", "hours", "audited_hours", "independent_or_other_hours",
    "control", "control_tokens", "control_kinds", "raw", "raw_bands", "normalization_notes", "source_cell_ids", "source_word_ids",
)


def load_rows(loads: DataFrame, sources: DataFrame) -> DataFrame:
    """Loads of semester_loads() as the LOAD_COLUMNS of a CSV file, with the cells and words behind each band (band_sources()). Lists and objects are JSON: raw holds each band's text, raw_bands its
    text, cells and words; source_cell_ids and source_word_ids are those of all bands, each once, in order."""
    key = ["table_id", "row_index", "semester"]
    found = sources.where("semester > 0").groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct("cell_ids", "word_ids")))).alias("_bands"))
    joined = loads.join(found, key, "left")
    none = F.array().cast("array<string>")
    ids = lambda f, kind: F.coalesce(F.try_element_at("_bands", F.lit(f))[kind], none)
    bands = F.struct(*[F.struct(F.col(f"raw.{f}").alias("text"), ids(f, "cell_ids").alias("cell_ids"), ids(f, "word_ids").alias("word_ids")).alias(f) for f in SEMESTER_FIELDS])
    every = lambda kind: F.to_json(F.array_sort(F.array_distinct(F.concat(*[ids(f, kind) for f in SEMESTER_FIELDS]))))
    made = {
        "id": F.col("load_id"), "raw_bands": F.to_json(bands), "raw": F.to_json("raw"), "source_cell_ids": every("cell_ids"), "source_word_ids": every("word_ids"),
        **{c: F.to_json(F.coalesce(c, none)) for c in ("control_tokens", "control_kinds", "normalization_notes")},
    }
    return joined.select(*[made.get(c, F.col(c)).alias(c) for c in LOAD_COLUMNS])


def write_loads(rows: DataFrame, path: str) -> None:
    """load_rows() as CSV files with a header, null as ""."""
    rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in LOAD_COLUMNS]).write.option("header", True).option("escape", '"').mode("overwrite").csv(path)


def band_sources(tables: DataFrame, cells: DataFrame, words: DataFrame, schemas: DataFrame, least: float = 0.1, parts: DataFrame | None = None) -> DataFrame:
    """(table_id, row_index, semester, field, cell_ids, word_ids): where each band's text comes from: the row's cells that share more than `least` with it, and its words whose middle lies in it, both
    as sorted sets. semester is 0 for base fields. Bands without either are left out. `parts`: placed() of the same tables, if it is there.

    A row's bands are as many as its document's schema has, so each is held against the row's own cells and words.
    """
    if least < 0:
        raise ValueError("least must be 0 or more")
    rows = placed(tables, cells, words, schemas) if parts is None else parts
    wide = lambda x: x["x1"] - x["x0"] > least
    shares = lambda c, b: wide(c) & (b["right"] - b["left"] > least) & (overlap(c["x0"], c["x1"], b["left"], b["right"]) > least)
    ids = lambda things, name: F.array_sort(F.array_distinct(F.array_compact(F.transform(things, lambda x: x[name]))))
    met = F.transform("bands", lambda b: F.struct(
        b["semester"].alias("semester"), b["field"].alias("field"), ids(F.filter("cells", lambda c: shares(c, b)), "cell_id").alias("cell_ids"), ids(F.filter("words", lambda w: _inside(w, b)), "word_id").alias("word_ids"),
    ))
    # The outer form reads the array once, as in extraction.py.
    return rows.select("table_id", "row_index", F.inline_outer(met)).where((F.size("cell_ids") > 0) | (F.size("word_ids") > 0))
