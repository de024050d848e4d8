"""The domain's plans bound to the test tables: nested cards, extracted documents, curriculum grids, canonical records, snapshots. Each with SQL that says the same."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import ids, numbers, text
from lectern.functions.lineage import cut, shared_folder, written
from lectern.operators import cards, integrity, ordered, project, relations
from lectern.plans import canonical, contracts, curriculum, extraction, materialized, semantic, snapshots
from lectern.registry import query, t
from lectern.sources import files


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that the cluster shares."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


# Nested cards: a card for each supplier, its nation as faculty and department, its balance as a score and a price.
def _cards(spark: SparkSession, d: str) -> DataFrame:
    nation = t(spark, d, "nation").select("n_nationkey", "n_name")
    s = t(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    key, n = F.col("s_suppkey"), F.col("n_name")
    odd = key % 2 == 1
    summary = F.struct(F.col("s_name").alias("slug"), F.concat(F.lit("Card "), key).alias("name"), key.cast("string").alias("code"),
                       F.array(F.struct(n.alias("slug"), n.alias("title"), F.array(F.struct(F.concat(F.lit("c"), F.col("s_nationkey")).alias("slug"), n.alias("title"))).alias("chairs"))).alias("faculties"))
    program = F.struct(F.concat(F.lit("p"), key).alias("id"), F.concat(F.lit("Program "), key).alias("name"), key.cast("string").alias("place"), F.array(n, F.lit(" ")).alias("discipline"), F.concat(F.lit("http://plan.example.com/"), n).alias("plan"))
    chair = F.struct(F.lit("").alias("slug"), F.concat(F.lit("d"), key).alias("code"), n.alias("title"), F.concat(F.lit("<p>About&nbsp;"), n, F.lit("</p><br>us")).alias("about"), F.lit("one;\n; two \n").alias("description"),
                     F.struct(F.array(F.struct(F.lit("2020").alias("year"), key.cast("string").alias("count"))).alias("points")).alias("oldPoints"), F.struct(F.array(program).alias("items")).alias("educationalProgram"))
    detail = F.struct(
        F.struct(F.when(odd, F.concat(F.lit("Full "), key)).alias("name"), F.when(odd, "да").otherwise("no").alias("military")).alias("additional"),
        F.array(F.struct(F.lit("Math").alias("title"), key.cast("string").alias("point"), F.lit("нет").alias("isChoice")), F.lit(None), F.struct(F.lit("Essay").alias("title"), F.lit("неизвестно").alias("point"), F.lit("1").alias("isChoice"))).alias("points"),
        F.array(F.struct(F.lit("full").alias("studyForm"), F.lit("2026").alias("term"), F.concat(key, F.lit(" 000,50 ₽")).alias("value"), F.lit("-").alias("discountValue"), F.lit("RUB").alias("currency"))).alias("price"),
        F.struct(F.array(F.lit("Course"), F.lit("")).alias("items")).alias("courses"), F.array(n).alias("specializations"), F.when(odd, F.struct(F.array(F.lit(None), chair).alias("items"))).alias("chairs"),
    )
    return cards.read_cards(s.select(F.to_json(summary).alias("summary"), F.to_json(detail).alias("detail")))


_SUPPLIERS = "(SELECT s_suppkey AS k, s_name, s_nationkey, n_name, s_suppkey % 2 = 1 AS odd FROM supplier JOIN nation ON n_nationkey = s_nationkey)"


@query(f"""
SELECT 'card:major:' || substr(sha1('major|' || lower(s_name)), 1, 20) AS id, s_name AS slug, CASE WHEN odd THEN 'Full ' ELSE 'Card ' END || k AS name, CAST(k AS VARCHAR) AS code, odd AS military, n_name AS faculty_name,
  1 + CAST(odd AS INTEGER) * 0 AS n_departments, 3 AS n_requirements, 1 AS n_prices FROM {_SUPPLIERS}
""")
def card_majors(spark, d):
    return cards.majors(_cards(spark, d)).drop("qualification")


@query(f"""
SELECT s_name AS slug, 0 AS ordinal, 'Math' AS title, k AS point, CAST(k AS VARCHAR) AS point_raw, NULL AS point_warning, false AS is_choice, 'card:entrance-requirement:' || substr(sha1('entrance-requirement|' || lower(s_name) || '|math|0'), 1, 20) AS legacy_id FROM {_SUPPLIERS}
UNION ALL SELECT s_name, 2, 'Essay', NULL, 'неизвестно', 'invalid_number', true, 'card:entrance-requirement:' || substr(sha1('entrance-requirement|' || lower(s_name) || '|essay|2'), 1, 20) FROM {_SUPPLIERS}
""")
def card_subjects(spark, d):
    return cards.entrance_subjects(_cards(spark, d))


@query(f"SELECT s_name AS slug, 'full' AS study_form, CAST(k * 1000 + 0.5 AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS discount, '-' AS discount_raw, CAST(NULL AS VARCHAR) AS discount_warning, 'RUB' AS currency FROM {_SUPPLIERS}")
def card_tuition(spark, d):
    return cards.tuition(_cards(spark, d)).select("slug", "study_form", F.col("value").cast("double").alias("value"), F.col("discount").cast("double").alias("discount"), "discount_raw", "discount_warning", "currency")


@query(f"""
SELECT s_name AS slug, 0 AS ordinal, CASE WHEN odd THEN 'd' || k ELSE 'c' || s_nationkey END AS department_key, n_name AS title, CASE WHEN odd THEN 'About ' || n_name || chr(10) || 'us' ELSE '' END AS about,
  CASE WHEN odd THEN 'one,two' ELSE '' END AS realized_programs, '' AS faculty FROM {_SUPPLIERS}
""")
def card_departments(spark, d):
    return cards.departments(_cards(spark, d)).withColumn("realized_programs", F.array_join("realized_programs", ","))


@query(f"SELECT s_name AS slug, '' AS department, 0 AS ordinal, CAST(2020 AS BIGINT) AS year, k AS count, CAST(k AS VARCHAR) AS count_raw FROM {_SUPPLIERS} WHERE odd")
def card_scores(spark, d):
    return cards.historical_scores(_cards(spark, d)).select("slug", "department", "ordinal", "year", "count", "count_raw")


@query(f"SELECT s_name AS slug, '' AS department, 0 AS ordinal, 'p' || k AS program_key, 'Program ' || k AS name, k AS places, 'http://plan.example.com/' || n_name AS plan_url FROM {_SUPPLIERS} WHERE odd")
def card_programs(spark, d):
    return cards.educational_programs(_cards(spark, d)).select("slug", "department", "ordinal", "program_key", "name", "places", "plan_url")


@query(f"""
SELECT 'major' AS scope, s_name AS slug, s_name AS owner, 'Course' AS name FROM {_SUPPLIERS} UNION ALL SELECT 'department', s_name, s_name, n_name FROM {_SUPPLIERS}
UNION ALL SELECT 'program', s_name, 'p' || k, n_name FROM {_SUPPLIERS} WHERE odd
""")
def card_disciplines(spark, d):
    return cards.disciplines(_cards(spark, d))


@query(f"""
SELECT 'http://plan.example.com/' || n_name AS plan_url, count(*) AS n_programs, string_agg('p' || k, ',' ORDER BY 'p' || k) AS programs, CASE WHEN n_name < 'M' THEN 'ok' ELSE 'error' END AS plan_status
FROM {_SUPPLIERS} WHERE odd GROUP BY n_name
""")
def card_plan_files(spark, d):
    resolved = t(spark, d, "nation").where("n_name < 'M'").select(F.concat(F.lit("http://plan.example.com/"), "n_name").alias("plan_url"), F.lit("ok").alias("plan_status"))
    return cards.with_files(cards.study_plan_files(_cards(spark, d)), resolved).select("plan_url", "n_programs", F.array_join("programs", ",").alias("programs"), "plan_status")


# Extracted documents: an order is a document, its lines are the rows of its only table.
def _documents(spark: SparkSession, d: str) -> DataFrame:
    # An order's lines are gathered as bare keys; its rows and words are made of them after the join. Orders are the smaller side, so they are hashed and nothing is sorted.
    items = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("items"))
    docs = t(spark, d, "orders").select("o_orderkey", "o_orderstatus").hint("shuffle_hash").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    cell = lambda c, at, r: F.struct(c.cast("string").alias("text"), F.lit(float(at)).alias("x0"), F.lit(at + 1.0).alias("x1"), F.array(F.concat(F.lit(f"w{at}-"), r)).alias("word_ids"))
    row = lambda x, i: F.array(cell(x["l_partkey"], 0, i + 1), cell(x["l_suppkey"], 1, i + 1))
    word = lambda _, i: F.struct(F.concat(F.lit("w0-"), i + 1).alias("id"), F.lit("x").alias("text"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("top"), F.lit(1.0).alias("x1"), F.lit(1.0).alias("bottom"))
    there = F.col("items").isNotNull()
    page = F.struct(F.lit(1).alias("page_number"), F.lit(10.0).alias("width"), F.lit(10.0).alias("height"), F.transform("items", word).alias("words"))
    body = F.struct(F.lit(0).alias("table_index"), F.lit(1).alias("page_number"), F.lit("curriculum").alias("section"), (F.size("items") + F.col("o_orderkey") % 2).cast("int").alias("row_count"), F.lit(2).alias("column_count"), F.lit(0.0).alias("x0"), F.lit(10.0).alias("x1"), F.transform("items", row).alias("rows"))
    return docs.select(F.col("o_orderkey").cast("string").alias("document_id"), F.when(there, "ok").otherwise("missing").alias("status"), F.when(there, F.array(page)).alias("pages"), F.when(there, F.array(body)).alias("tables"))


_LINES = "(SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS i FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))"


@query(f"""
SELECT 'plan:row:' || substr(sha1('row|plan:table:' || substr(sha1('table|' || l_orderkey || '|0'), 1, 20) || '|' || i), 1, 20) AS row_id, CAST(l_orderkey AS VARCHAR) AS document_id, CAST(i AS INTEGER) AS row_index,
  CAST(l_partkey AS VARCHAR) AS first_cell, CAST(l_suppkey AS VARCHAR) AS second_cell, 2 AS cell_count FROM {_LINES}
""")
def extracted_rows(spark, d):
    return extraction.flatten(_documents(spark, d))["rows"].select("row_id", "document_id", "row_index", "first_cell", "second_cell", "cell_count")


@query(f"SELECT CAST(l_orderkey AS VARCHAR) AS document_id, CAST(i AS INTEGER) AS row_index, c AS column_index, CAST(CASE c WHEN 0 THEN l_partkey ELSE l_suppkey END AS VARCHAR) AS text FROM {_LINES} CROSS JOIN (SELECT unnest([0, 1]) AS c)")
def extracted_cells(spark, d):
    return extraction.flatten(_documents(spark, d))["cells"].select("document_id", "row_index", "column_index", "text")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS document_id, CASE WHEN n IS NULL THEN 'missing' ELSE 'ok' END AS status, CAST(n IS NOT NULL AS INTEGER) AS page_count, CAST(n IS NOT NULL AS INTEGER) AS table_count, coalesce(n, 0) AS n_words FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def extracted_documents(spark, d):
    flat = extraction.flatten(_documents(spark, d))
    words = flat["words"].groupBy("document_id").agg(F.count("*").alias("n_words"))
    return flat["documents"].join(words, "document_id", "left").withColumn("n_words", F.coalesce("n_words", F.lit(0)))


@query(f"""
SELECT 'declared_row_counts' AS "check", count(DISTINCT l_orderkey) AS n FROM {_LINES} WHERE l_orderkey % 2 = 1
UNION ALL SELECT 'unknown_words', count(*) FROM {_LINES}
""")
def extraction_checks(spark, d):
    failed = extraction.quality(extraction.flatten(written(_documents(spark, d))))["failed"]
    return spark.createDataFrame([(name, x["n"]) for name, x in failed.items()], "check string, n long")


@query(f"SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS document_id, 'curriculum' AS section, CAST(count(*) OVER (PARTITION BY l_orderkey) + l_orderkey % 2 AS INTEGER) AS row_count FROM {_LINES}")
def extracted_tables(spark, d):
    tables = extraction.flatten(_documents(spark, d))["tables"]
    path = scratch(spark)
    kept = written(tables)
    extraction.write({"tables": kept.unionByName(kept)}, path)
    return extraction.first_tables(spark.read.parquet(f"{path}/tables")).select("document_id", "section", "row_count")


# Curriculum grids: a nation is a document, its customers are the disciplines of its table.
def _grid(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    head = [(0, 0, "Шифр", 0.0), (0, 1, "Наименование", 5.0), (0, 2, "Кафедра", 10.0), (2, 3, "Общая, з.е.", 15.0), (2, 4, "Общая, час", 20.0), (0, 10, "1 - 17 недель", 50.0), (0, 15, "2 - 17 недель", 75.0)]
    heads = spark.createDataFrame(head, "row_index int, column_index int, text string, x0 double")
    document = F.col("n_nationkey").cast("string")
    nations = t(spark, d, "nation")
    tables = nations.select(F.concat(F.lit("t"), document).alias("table_id"), document.alias("document_id"), F.lit(1).alias("page_number"), F.lit(0).alias("ordinal"), F.lit("curriculum").alias("section"), F.lit(0.0).alias("x0"), F.lit(100.0).alias("x1"))
    named = nations.select(F.concat(F.lit("t"), document).alias("table_id"), F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(r, heads.columns, strict=True)]) for r in head])).alias("h")).select("table_id", "h.*")
    customers = t(spark, d, "customer").join(nations.select("n_nationkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    own = customers.withColumn("row_index", (4 + F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))).cast("int"))
    big, key = F.col("c_custkey") % 3 == 0, F.col("c_custkey")
    texts = [(0, key.cast("string")), (1, F.col("c_name")), (2, F.col("c_mktsegment")), (3, (key % 7).cast("string")), (4, (key % 7 * 36).cast("string")), (10, (key % 7).cast("string")), (11, (key % 7 * 36).cast("string")), (14, F.when(big, "Экз").otherwise("Зчт"))]
    cell = F.explode(F.array(*[F.struct(F.lit(at).alias("column_index"), x.alias("text"), F.lit(5.0 * at).alias("x0")) for at, x in texts])).alias("c")
    body = own.select(F.concat(F.lit("t"), F.col("c_nationkey").cast("string")).alias("table_id"), "row_index", cell).select("table_id", "row_index", "c.*")
    cells = named.unionByName(body).select("table_id", "row_index", "column_index", F.concat_ws("-", "table_id", "row_index", "column_index").alias("cell_id"), "text", "x0", (F.col("x0") + 5).alias("x1"), F.array().cast("array<string>").alias("word_ids"))
    words = spark.createDataFrame([], "document_id string, page_number int, word_id string, text string, x0 double, x1 double, top double")
    return tables, cells, words


def _plan(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    tables, cells, words = _grid(spark, d)
    cells = cut(cells)
    schemas = written(curriculum.discover_schemas(tables, cells))
    rows = cut(curriculum.semantic_rows(written(curriculum.band_texts(tables, cells, words, schemas))))
    disciplines = curriculum.disciplines(rows)
    return tables, schemas, rows, disciplines, curriculum.semester_loads(disciplines)


_CUSTOMERS = "(SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) + 4 AS r FROM customer JOIN nation ON n_nationkey = c_nationkey)"


@query("SELECT CAST(n_nationkey AS VARCHAR) AS document_id, 0.5::DOUBLE AS start, 2 AS n_semesters, 17 AS weeks, 0.05::DOUBLE AS name_left FROM nation")
def curriculum_schemas(spark, d):
    tables, cells, _ = _grid(spark, d)
    return curriculum.discover_schemas(tables, cells).select("document_id", "start", F.col("count").alias("n_semesters"), F.element_at("weeks", F.lit(2)).alias("weeks"), F.element_at("spans", F.lit("name"))["left"].alias("name_left"))


@query(f"""
SELECT 't' || c_nationkey AS table_id, CAST(r AS INTEGER) AS row_index, 'discipline' AS row_kind, CAST(c_custkey AS VARCHAR) AS code, c_name AS name, c_mktsegment AS department, 'unknown' AS part_type, '' AS section_path,
  CAST(c_custkey % 7 AS DOUBLE) AS total_credits, CAST(c_custkey % 7 * 36 AS DOUBLE) AS total_hours FROM {_CUSTOMERS}
""")
def curriculum_rows(spark, d):
    return _plan(spark, d)[2].select("table_id", "row_index", "row_kind", "code", "name", "department", "part_type", "section_path", "total_credits", "total_hours")


@query(f"""
SELECT CAST(c_custkey AS VARCHAR) AS code, s AS semester, 17 AS weeks, s = 1 AS active, s = 1 AS has_numeric_load, CASE WHEN s = 1 THEN CAST(c_custkey % 7 AS DOUBLE) END AS credits, CASE WHEN s = 1 THEN CAST(c_custkey % 7 * 36 AS DOUBLE) END AS hours,
  CASE WHEN s = 2 THEN '' WHEN c_custkey % 3 = 0 THEN 'exam' ELSE 'credit' END AS control_kinds FROM {_CUSTOMERS} CROSS JOIN (SELECT unnest([1, 2]) AS s)
""")
def curriculum_loads(spark, d):
    return _plan(spark, d)[4].select("code", "semester", "weeks", "active", "has_numeric_load", "credits", "hours", F.array_join("control_kinds", ",").alias("control_kinds"))


def _semantic(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """The plan in the form of the semantic checks, with faults: a nation without rows read, blank names, controls without a meaning, unknown disciplines."""
    tables, schemas, rows, disciplines, loads = _plan(spark, d)
    rows = rows.select(F.concat_ws(":", "table_id", "row_index").alias("id"), F.when(F.col("row_index") % 10 != 0, F.col("cell_ids")).alias("source_cell_ids"))
    code = F.col("code").cast("long")
    disciplines = disciplines.select(F.concat(F.lit("d"), "code").alias("id"), "code", F.when(code % 11 != 0, F.col("name")).alias("name"), "department", "part_type", F.col("total_credits").alias("credits"), F.lit(None).cast("double").alias("audited_hours"), F.when(code % 5 == 0, F.col("total_hours") + 1).otherwise(F.col("total_hours")).alias("hours"))
    raw = F.create_map(F.lit("hours"), F.when(code % 13 == 0, "72 Экз").otherwise("72"))
    loads = loads.select(F.concat_ws(":", "code", "semester").alias("id"), F.when(code % 17 == 0, "nobody").otherwise(F.concat(F.lit("d"), "code")).alias("discipline_id"), "semester", "active", "has_numeric_load", F.when(code % 19 == 0, "unknown words").otherwise(F.col("control")).alias("control"), F.when(code % 19 == 0, F.array().cast("array<string>")).otherwise(F.col("control_tokens")).alias("control_tokens"), raw.alias("raw"), "hours")
    schemas = schemas.select("document_id", F.col("count").alias("semester_count"), F.array().cast("array<string>").alias("warnings"))
    return tables, schemas, rows, disciplines, loads, tables.where("document_id <> '3'").select("table_id")


@query(f"""
WITH c AS (SELECT c_custkey AS k, r, c_custkey % 7 * 36 AS h FROM {_CUSTOMERS}), n AS (
  SELECT 'all_curriculum_tables_read' AS "check", count(*) AS n FROM nation WHERE n_nationkey = 3 UNION ALL SELECT 'all_curriculum_documents_have_schema', 0 UNION ALL SELECT 'discipline_ids_unique', 0
  UNION ALL SELECT 'discipline_subject_fields_present', count(*) FROM c WHERE k % 11 = 0 UNION ALL SELECT 'semester_loads_reference_disciplines', 2 * count(*) FROM c WHERE k % 17 = 0 UNION ALL SELECT 'semester_load_ids_unique', 0
  UNION ALL SELECT 'all_semantic_rows_reference_cells', count(*) FROM c WHERE r % 10 = 0 UNION ALL SELECT 'allocated_semester_totals_reconcile', count(*) FROM c WHERE k % 5 = 0 AND k % 17 <> 0
  UNION ALL SELECT 'no_control_tokens_in_numeric_semester_fields', 2 * count(*) FROM c WHERE k % 13 = 0 UNION ALL SELECT 'all_control_fields_classified', 2 * count(*) FROM c WHERE k % 19 = 0
  UNION ALL SELECT 'no_unexplained_active_semester_rows', 0 UNION ALL SELECT 'no_schema_warnings', 0
  UNION ALL SELECT 'curriculum_contract_unique_discipline_ids', 0 UNION ALL SELECT 'curriculum_contract_discipline_code_and_name_present', count(*) FROM c WHERE k % 11 = 0
  UNION ALL SELECT 'curriculum_contract_semester_loads_reference_disciplines', 2 * count(*) FROM c WHERE k % 17 = 0 UNION ALL SELECT 'curriculum_contract_unique_semester_load_ids', 0
  UNION ALL SELECT 'curriculum_contract_semantic_rows_have_source_cells', count(*) FROM c WHERE r % 10 = 0
) SELECT "check", n = 0 AS passed, CAST(n AS BIGINT) AS n, CAST(least(n, 20) AS INTEGER) AS n_examples FROM n UNION ALL SELECT 'passed', bool_and(n = 0), CAST(sum(n) AS BIGINT), 0 FROM n
""")
def semantic_report(spark, d):
    return semantic.report(*_semantic(spark, d)).select("check", "passed", "n", F.size("examples").alias("n_examples"))


@query(f"""
WITH c AS (SELECT c_custkey AS k FROM {_CUSTOMERS})
SELECT 'disciplines_without_total_credits' AS gap, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'disciplines_without_audited_hours', count(*) FROM c UNION ALL SELECT 'disciplines_without_department', 0
UNION ALL SELECT 'disciplines_with_unknown_part_type', count(*) FROM c UNION ALL SELECT 'unallocated_total_without_semester_rows', count(*) FROM c WHERE k % 17 = 0 AND (k % 7 > 0 OR k % 5 = 0)
""")
def semantic_gaps(spark, d):
    _, _, _, disciplines, loads, _ = _semantic(spark, d)
    return semantic.source_gaps(disciplines, loads)


@query(f"""
WITH c AS (SELECT c_custkey AS k, r FROM {_CUSTOMERS})
SELECT 'discipline_code_and_name_present' AS rule, 'error' AS severity, count(*) AS n FROM c WHERE k % 11 = 0 UNION ALL SELECT 'semester_loads_reference_disciplines', 'error', 2 * count(*) FROM c WHERE k % 17 = 0
UNION ALL SELECT 'semantic_rows_have_source_cells', 'error', count(*) FROM c WHERE r % 10 = 0 UNION ALL SELECT 'known_part_type', 'warning', count(*) FROM c
""")
def contract_lint(spark, d):
    _, _, rows, disciplines, loads, _ = _semantic(spark, d)
    return semantic.contract_violations(rows, disciplines, loads).groupBy("rule", "severity").agg(F.count("*").alias("n"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS id, 'plan' AS namespace, 'report' AS kind FROM customer WHERE c_custkey % 4 = 1 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'plan', 'report' FROM customer WHERE c_custkey % 4 = 2
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'plan', 'warnings' FROM customer WHERE c_custkey % 5 = 0
""")
def semantic_failures(spark, d):
    kind, bad, good = F.col("c_custkey") % 4, '{"verification":{"passed":false}}', '{"verification":{"passed":true}}'
    entries = F.map_filter(F.create_map(
        F.lit("semantic_report"), F.when(kind == 1, bad).when(kind == 3, good), F.lit("semantic_reports"), F.when(kind == 2, f"[{bad},{good}]"), F.lit("semantic_warnings"), F.when(F.col("c_custkey") % 5 == 0, '["w"]').otherwise("[]"),
    ), lambda k, v: v.isNotNull())
    rows = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.create_map(F.lit("plan"), entries).alias("extensions"))
    return semantic.failures(rows).select("id", "namespace", "kind")


@query("""
SELECT 'empty_source_key' AS rule, count(*) AS n FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT 'no_provenance', count(*) FROM documents WHERE doc_id % 7 = 0
UNION ALL SELECT 'provenance_of_another_key', count(*) FROM documents WHERE doc_id % 7 > 0 AND doc_id % 6 = 0 UNION ALL SELECT 'no_locator', count(*) FROM documents WHERE doc_id % 7 > 0 AND doc_id % 4 = 0
UNION ALL SELECT 'no_lineage', count(*) FROM documents WHERE doc_id % 7 > 0 AND doc_id % 9 = 0 UNION ALL SELECT 'blank_legacy_id', count(*) FROM documents WHERE doc_id % 8 = 0
UNION ALL SELECT 'duplicate_source_key', count(*) FROM (SELECT doc_id // 2 FROM documents WHERE doc_id % 10 <> 0 GROUP BY doc_id // 2 HAVING count(*) > 1)
""")
def source_contract(spark, d):
    i = F.col("doc_id")
    key = F.when(i % 10 == 0, " ").otherwise(F.expr("cast(doc_id div 2 as string)"))
    provenance = F.when(i % 7 > 0, F.struct(F.when(i % 4 > 0, F.concat(F.lit("https://h.example.com/"), i)).alias("source_page"), F.lit("").alias("list_api"), F.lit("x").alias("detail_api"), F.lit(None).cast("string").alias("detail_page"), F.when(i % 6 == 0, "other").otherwise(F.trim(key)).alias("source_key"), F.when(i % 9 > 0, "raw/x").alias("raw_snapshot_path")))
    rows = t(spark, d, "documents").select(key.alias("source_key"), provenance.alias("provenance"), F.when(i % 8 == 0, F.array(F.lit("a"), F.lit(" "))).alias("legacy_ids"))
    return contracts.violations(rows, persists_raw=True).groupBy("rule").agg(F.count("*").alias("n"))


# Canonical records.
def _sha(kind: str, key: str) -> str:
    return f"'university:shop:{kind}:' || substr(sha256('shop|{kind}|' || {key}), 1, 24)"


def _provenance():
    return F.struct(F.lit("k").alias("source_key"), F.lit("https://h.example.com").alias("source_url"), F.lit("raw/x").alias("raw_snapshot_path"))


def _programs(spark: SparkSession, d: str, on: bool = True) -> tuple[DataFrame, DataFrame]:
    part = t(spark, d, "part").select(F.concat(F.lit("HTTPS://Shop.example.com:443/Part/"), F.col("p_partkey"), F.lit("/?b=2&a=1#x")).alias("source_key"), F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("code"),
                                     F.concat(F.lit(" Straße  "), "p_brand").alias("study_direction_key"), F.col("p_type").alias("study_direction_name"), F.lit("").alias("study_direction_code"), "p_partkey", _provenance().alias("provenance"))
    return canonical.programs(part, "Shop", ["p_partkey"], {"study_direction": on})


@query(f"""
SELECT {_sha("program", "'https://shop.example.com/Part/' || p_partkey || '?a=1&b=2'")} AS id, p_name AS name, {_sha("study_direction", "'strasse ' || lower(p_brand)")} AS study_direction_id, 'published' AS name_status FROM part
""")
def canonical_programs(spark, d):
    return _programs(spark, d)[0].select("id", "name", "study_direction_id", F.col("field_meta.name.status").alias("name_status"))


@query(f"SELECT {_sha('study_direction', 's')} AS id, arg_min(p_type, p_partkey) AS name, ' Straße  ' || min(p_brand) AS raw FROM (SELECT *, 'strasse ' || lower(p_brand) AS s FROM part) GROUP BY s")
def canonical_directions(spark, d):
    return _programs(spark, d)[1].select("id", "name", F.concat(F.lit(" "), "code").alias("raw"))


@query("SELECT p_partkey AS key, 'study_direction_id' AS field, 'Straße  ' || p_brand AS source_key FROM part")
def unresolved_references(spark, d):
    rows = _programs(spark, d, on=False)[0]
    found = canonical.unresolved_references(rows, "Shop").join(rows.select("id", F.col("code").cast("long").alias("key")), "id")
    return found.select("key", "field", "source_key")


def _graph(spark: SparkSession, d: str) -> dict[str, tuple[str, DataFrame]]:
    """Nations with odd keys are departments, customers name theirs; ids are made of web addresses and letters beyond ASCII."""
    key = lambda c: F.concat(F.lit("https://X.example/Straße/"), c)
    nation = t(spark, d, "nation").where("n_nationkey % 2 = 1").select(key("n_nationkey").alias("source_key"), F.col("n_name").alias("name"), _provenance().alias("provenance"))
    customer = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("source_key"), F.col("c_name").alias("name"), F.when(F.col("c_nationkey") > 0, key("c_nationkey")).alias("nation_key"), _provenance().alias("provenance"))
    return {
        "departments": ("department", canonical.materialize(nation, "Shop", "department", ["name"])),
        "teachers": ("teacher", canonical.materialize(customer, "Shop", "teacher", ["name"], {"department_id": ("nation_key", "department")})),
    }


@query("""
SELECT 'department_id' AS type, 'kept' AS state, count(*) AS n FROM customer WHERE c_nationkey % 2 = 1 UNION ALL SELECT 'department_id', 'broken', count(*) FROM customer WHERE c_nationkey % 2 = 0 AND c_nationkey > 0
UNION ALL SELECT 'scope', 'broken', (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation WHERE n_nationkey % 2 = 1)
""")
def canonical_graph(spark, d):
    _, links, broken = canonical.ontology(_graph(spark, d), "Shop")
    both = links.withColumn("state", F.lit("kept")).unionByName(broken.withColumn("state", F.lit("broken")))
    return both.groupBy("type", "state").agg(F.count("*").alias("n"))


@query("SELECT 'department' AS type, 'departments' AS datasets, count(*) AS n FROM nation WHERE n_nationkey % 2 = 1 UNION ALL SELECT 'teacher', 'teachers', count(*) FROM customer")
def canonical_objects(spark, d):
    objects, _, _ = canonical.ontology(_graph(spark, d), "Shop")
    return objects.groupBy("type", F.array_join("datasets", ",").alias("datasets")).agg(F.count("*").alias("n"))


@query("""
SELECT 'departments' AS name, 'published' AS status, (SELECT count(*) FROM nation WHERE n_nationkey % 2 = 1) AS n UNION ALL SELECT 'teachers', 'degraded', count(*) FROM customer UNION ALL SELECT 'rooms', 'not_published', 0
UNION ALL SELECT 'news', 'not_supported', 0 UNION ALL SELECT 'passed', 'false', 0
""")
def canonical_quality(spark, d):
    records = {name: df for name, (_, df) in _graph(spark, d).items()}
    report = canonical.quality_report(records, "Shop", {"departments": True, "teachers": True, "rooms": True, "news": False}, {}, None, {"teachers": "degraded"})
    rows = [(name, status, report["counts"].get(name, 0)) for name, status in report["capability_status"].items()]
    return spark.createDataFrame([*rows, ("passed", str(report["passed"]).lower(), 0)], "name string, status string, n long")


_HOURS = "CASE l_linenumber % 3 WHEN 0 THEN l_extendedprice WHEN 1 THEN l_quantity + 1.0 ELSE l_quantity * 36.0 END::DOUBLE"


def _curricula(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    kind = F.col("l_linenumber") % 3
    rows = t(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("curriculum_key"), F.concat_ws("-", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("string"), "l_linenumber").alias("code"), F.lit(None).cast("string").alias("discipline"), F.col("l_returnflag").alias("name"),
        F.lit("").alias("department"), F.lit("").alias("section_path"), F.when(F.col("l_linenumber") < 6, F.col("l_linenumber").cast("string")).otherwise("x").alias("semester"), F.when(kind == 0, F.col("l_extendedprice").cast("double")).alias("total_hours"), F.col("l_quantity").cast("double").alias("credits"),
        F.when(kind == 1, F.create_map(F.lit("a"), F.col("l_quantity").cast("double"), F.lit("b"), F.lit(1.0))).alias("components"), F.lit(None).cast(canonical.LOADS).alias("semester_loads"), _provenance().alias("provenance"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )
    return canonical.curricula(rows, "Shop", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query(f"""
SELECT name, hours_method, hours_status, count(*) AS n, round(sum(h), 2) AS hours FROM (
  SELECT l_returnflag AS name, CASE l_linenumber % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'sum_components' ELSE 'credits_to_hours' END AS hours_method, CASE WHEN l_linenumber % 3 = 0 THEN 'published' ELSE 'derived' END AS hours_status, {_HOURS} AS h FROM lineitem
) GROUP BY ALL
""")
def canonical_disciplines(spark, d):
    found = _curricula(spark, d)["disciplines"]
    return found.groupBy("name", "hours_method", "hours_status").agg(F.count("*").alias("n"), F.round(F.sum("total_hours"), 2).alias("hours"))


@query(f"SELECT CAST(l_linenumber AS INTEGER) AS number, {_sha('semester', 'l_linenumber')} AS semester_id, count(*) AS n, round(sum({_HOURS}), 2) AS hours FROM lineitem WHERE l_linenumber < 6 GROUP BY l_linenumber")
def canonical_loads(spark, d):
    return _curricula(spark, d)["semester_loads"].groupBy("number", "semester_id").agg(F.count("*").alias("n"), F.round(F.sum("hours"), 2).alias("hours"))


@query(f"SELECT CAST(l_linenumber AS INTEGER) AS number, {_sha('semester', 'l_linenumber')} AS id FROM (SELECT DISTINCT l_linenumber FROM lineitem WHERE l_linenumber < 6)")
def canonical_semesters(spark, d):
    return _curricula(spark, d)["semesters"].select("number", "id")


@query("""
SELECT 'order' AS entity_type, 'old' || o_orderkey AS legacy_id, 'new' || o_orderkey AS canonical_id FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'order', 'own' || o_orderkey, 'new' || o_orderkey FROM orders
UNION ALL SELECT 'order', 'older' || o_orderkey, 'old' || o_orderkey FROM orders WHERE o_orderkey % 5 = 0
""")
def canonical_aliases(spark, d):
    orders, kind = t(spark, d, "orders").select(F.col("o_orderkey").alias("k")), F.lit("order").alias("entity_type")
    url = F.concat(F.lit("HTTP://H.example.com:80/"), "k")
    old = orders.select(kind, F.concat(F.when(F.col("k") % 3 == 0, "old").otherwise("new"), "k").alias("id"), url.alias("source_key"))
    new = orders.select(kind, F.concat(F.lit("new"), "k").alias("id"), F.concat(F.lit("http://h.example.com/"), "k", F.lit("#top")).alias("source_key"), F.array(F.concat(F.lit("own"), "k")).alias("legacy_ids"))
    kept = orders.where("k % 5 = 0").select(kind, F.concat(F.lit("older"), "k").alias("legacy_id"), F.concat(F.lit("old"), "k").alias("canonical_id"))
    return canonical.checked_aliases(old, new, kept)


@query("""
WITH RECURSIVE links AS (
  SELECT '' AS entity_type, 'u' || p_partkey AS alias, 'u' || (p_partkey // 2) AS target FROM part WHERE p_partkey > 0 UNION ALL SELECT 'part', 'u' || p_partkey, 'u' || (p_partkey // 3) FROM part WHERE p_partkey % 2 = 0 AND p_partkey > 0
), effective AS (
  SELECT * FROM links WHERE entity_type = '' UNION ALL SELECT * FROM links WHERE entity_type = 'part' UNION ALL SELECT 'part', alias, target FROM links AS l WHERE entity_type = '' AND NOT EXISTS (SELECT 1 FROM links AS o WHERE o.entity_type = 'part' AND o.alias = l.alias)
), walk AS (
  SELECT entity_type, alias, target, 1 AS depth FROM effective UNION ALL SELECT w.entity_type, w.alias, e.target, depth + 1 FROM walk AS w JOIN effective AS e ON e.entity_type = w.entity_type AND e.alias = w.target
) SELECT entity_type, alias, arg_max(target, depth) AS target FROM walk GROUP BY 1, 2
""")
def typed_aliases(spark, d):
    part = t(spark, d, "part")
    name = lambda e: F.concat(F.lit("u"), F.expr(e))
    plain = part.where("p_partkey > 0").select(F.lit(None).cast("string").alias("entity_type"), name("p_partkey").alias("alias"), name("p_partkey div 2").alias("target"))
    typed = part.where("p_partkey % 2 = 0 and p_partkey > 0").select(F.lit("part").alias("entity_type"), name("p_partkey").alias("alias"), name("p_partkey div 3").alias("target"))
    return relations.alias_closure(plain.unionByName(typed))


@query("""
SELECT l_partkey, min(l_shipmode) AS shipped, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY first) AS sources FROM (
  SELECT l_partkey, l_suppkey, min((l_orderkey, l_linenumber, l_extendedprice)) AS first, NULL AS l_shipmode FROM lineitem GROUP BY 1, 2
) GROUP BY 1
""")
def provenance_merge(spark, d):
    place = F.struct("l_orderkey", "l_linenumber", "l_extendedprice")
    rows = t(spark, d, "lineitem").select("l_partkey", F.lit(None).cast("string").alias("shipped"), place.alias("o"), F.array(F.col("l_suppkey").cast("string")).alias("sources"))
    return relations.merge_provenance(rows, ["l_partkey"], ["shipped"], "o").withColumn("sources", F.array_join("sources", ","))


@query("""
WITH e AS (
  SELECT p_partkey, p_brand, p_name, CASE WHEN p_size % 3 = 0 THEN 'code_name' WHEN p_size % 3 = 1 THEN 'name_department' ELSE 'source' END AS kind,
    CASE WHEN p_size % 3 = 0 THEN lower(p_brand) || '|' || lower(p_name) WHEN p_size % 3 = 1 THEN lower(p_name) || '|' || lower(p_type) ELSE CAST(p_partkey AS VARCHAR) END AS value, p_size FROM part
) SELECT kind, value, count(*) AS n, count(DISTINCT p_size) AS n_documents, CASE WHEN count(DISTINCT CASE WHEN p_size % 3 < 2 THEN CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END END) > 1 THEN 'ambiguous' ELSE 'resolved' END AS status FROM e GROUP BY 1, 2
""")
def entity_index(spark, d):
    kind = F.col("p_size") % 3
    name = F.when(kind < 2, F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")))
    rows = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.when(kind == 0, F.concat(F.lit(" "), "p_brand")).alias("code"), name.alias("name"), F.col("p_type").alias("department"), F.col("p_size").alias("document_id"))
    return integrity.entity_index(rows, "shop")["entities"].select("kind", "value", "n", "n_documents", "status")


@query("""
SELECT w.l_orderkey, w.l_linenumber AS word, c.l_linenumber AS cell FROM lineitem AS w JOIN lineitem AS c ON w.l_orderkey = c.l_orderkey
WHERE w.l_quantity + 1 BETWEEN c.l_quantity - 0.6 AND c.l_quantity + 10.6 AND w.l_partkey % 100 + 2 BETWEEN c.l_partkey % 100 - 0.6 AND c.l_partkey % 100 + 50.6
""")
def words_in_cells(spark, d):
    x, y = F.col("l_quantity").cast("double"), (F.col("l_partkey") % 100).cast("double")
    words = t(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("word"), x.alias("x0"), (x + 2).alias("x1"), y.alias("top"), (y + 4).alias("bottom"))
    cells = t(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("cell"), x.alias("left"), (x + 10).alias("right"), y.alias("upper"), (y + 50).alias("lower"))
    return ordered.words_in_cells(words, cells, ["l_orderkey"]).select("l_orderkey", "word", "cell")


@query("""
SELECT l_orderkey, CAST(min(l_quantity) AS DOUBLE) AS x0, CAST(max(l_quantity) + 2 AS DOUBLE) AS x1, CAST(min(l_partkey) AS DOUBLE) AS top, CAST(max(l_partkey) + 4 AS DOUBLE) AS bottom,
  string_agg(l_returnflag, ' ' ORDER BY l_quantity, l_partkey, l_returnflag) AS text, count(*) AS n_words FROM lineitem GROUP BY 1
""")
def line_envelopes(spark, d):
    x, y = F.col("l_quantity").cast("double"), F.col("l_partkey").cast("double")
    words = t(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("text"), x.alias("x0"), (x + 2).alias("x1"), y.alias("top"), (y + 4).alias("bottom"))
    return ordered.line_envelopes(words, ["l_orderkey"])


@query("""
WITH RECURSIVE walk AS (SELECT CAST(1 AS BIGINT) AS node, 0 AS depth UNION ALL SELECT p_partkey, depth + 1 FROM walk JOIN part ON p_partkey // 2 = node AND p_partkey > 1 WHERE depth < 8) SELECT node, min(depth) AS depth FROM walk GROUP BY 1
""")
def reachable_nodes(spark, d):
    edges = t(spark, d, "part").where("p_partkey > 1").select(F.expr("p_partkey div 2").alias("parent"), F.col("p_partkey").alias("child"))
    return relations.tree(edges, spark.range(1, 2).toDF("node"))


# Files, snapshots, ledgers.
@query(" UNION ALL ".join(f"SELECT '{f}' AS format, c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment || chr(10) || '\"quoted\", ü' ELSE {none} END AS note FROM customer" for f, none in (("csv", "''"), ("jsonl", "NULL"), ("parquet", "NULL"))))
def stored_formats(spark, d):
    rows = t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_custkey") % 3 > 0, F.concat("c_mktsegment", F.lit('\n"quoted", ü'))).alias("note"))
    at = scratch(spark)
    files.write_csv(rows, f"{at}/csv")
    files.write_jsonl(rows, f"{at}/jsonl")
    rows.write.parquet(f"{at}/parquet/rows")
    back = files.typed(files.read_csv(spark, f"{at}/csv", sorted(rows.columns)), ["c_custkey", "c_acctbal"]).withColumn("c_custkey", F.col("c_custkey").cast("long"))
    found = {"csv": back, "jsonl": files.read_jsonl(spark, f"{at}/jsonl", rows.schema), "parquet": files.read_snapshot(spark, f"{at}/parquet", ["rows", "absent"])["rows"]}
    parts = [df.select(F.lit(name).alias("format"), *rows.columns) for name, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT 'nation' AS dataset, count(*) AS n, 'true' AS passed FROM nation UNION ALL SELECT 'region', count(*), 'true' FROM region UNION ALL SELECT 'refused', 0, 'false'")
def published_snapshot(spark, d):
    root, keys = scratch(spark), {"nation": "n_nationkey", "region": "r_regionkey"}
    first = snapshots.publish(spark, root, "run-1", {n: t(spark, d, n) for n in keys}, tuple(keys), keys)
    nation = t(spark, d, "nation")
    refused = snapshots.publish(spark, root, "run-2", {"nation": nation.unionByName(nation)}, ("nation",), keys)
    found = files.read_snapshot(spark, snapshots.active(spark, root), [*keys, "refused"])
    rows = [(name, df.count(), str(first["passed"]).lower()) for name, df in found.items()]
    return spark.createDataFrame([*rows, ("refused", 0, str(refused["passed"]).lower())], "dataset string, n long, passed string")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderkey % 4 = 0 AND o_orderstatus <> 'F')")
def resumed_rows(spark, d):
    orders = t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    ledger = snapshots.ledger_of(orders.where("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "F", "old").otherwise(F.col("o_orderstatus"))), "o_orderkey", "o_orderstatus")
    return snapshots.resume(orders, ledger, "o_orderkey", "o_orderstatus", lambda df: df)


# Scalars over whole texts.
@query(r"""
SELECT doc_id, TRY_CAST(replace(regexp_extract(text, '[-+]?\d+([.,]\d+)?'), ',', '.') AS DOUBLE) AS number, trim(regexp_replace(text, '\s+', ' ', 'g')) AS cleaned, CASE WHEN trim(lang) <> '' THEN trim(lang) ELSE trim(source) END AS first,
  CAST(n_chars AS INTEGER) AS positive, source IN ('1', 'true', 'yes', 'да') AS flag FROM documents WHERE n_chars > 0
""")
def text_scalars(spark, d):
    flag = F.coalesce(text.bool_or_none(F.col("source")), F.lit(False))
    return t(spark, d, "documents").where("n_chars > 0").select("doc_id", numbers.first_number(F.col("text")).alias("number"), text.clean(F.col("text")).alias("cleaned"), text.first_text(F.lit(None), F.col("lang"), F.col("source")).alias("first"), numbers.positive_int(F.col("n_chars").cast("string")).alias("positive"), flag.alias("flag"))


@query(r"""
SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(trim(url), '[^\w.-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'file') AS slug, regexp_replace(regexp_replace(trim(url), '[<>:"/\\|?*]', '_', 'g'), '^[ .]+|[ .]+$', '', 'g') AS name,
  'html' AS kind, regexp_extract(url, '^([a-z]+://[^/]+)', 1) || '/x?y=' || page_id AS link FROM pages
""")
def file_names(spark, d):
    link = text.resolve_url(F.col("url"), F.concat(F.lit(" /x?y="), F.col("page_id")))
    return t(spark, d, "pages").select("page_id", text.slug(F.col("url")).alias("slug"), text.safe_filename(F.col("url")).alias("name"), text.sniff(F.col("html").cast("binary")).alias("kind"), link.alias("link"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) AS back, true AS plain, least(1.0, greatest(0.0, l_discount * 20))::DOUBLE AS \"right\" FROM lineitem")
def wire_numbers(spark, d):
    wired = numbers.wire(F.col("l_extendedprice").cast("decimal(18,2)"))
    clamped = numbers.clamp(F.lit(0.0), F.col("l_discount").cast("double") * 20)
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", wired.cast("double").alias("back"), (~wired.rlike(r"\.\d*0$|\.$|[eE]")).alias("plain"), clamped["right"].alias("right"))


@query("SELECT o_orderkey, 'university:shop:order:' || substr(sha256('shop|order|' || lower(o_orderpriority) || CASE WHEN n > 1 THEN '|' || tail ELSE '' END), 1, 24) AS record_id FROM (SELECT *, count(*) OVER (PARTITION BY o_orderpriority) AS n, 'duplicate:' || row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS tail FROM orders)")
def record_ids(spark, d):
    return ids.record_ids(t(spark, d, "orders").withColumn("payload", F.lit(1)), "shop", "order", ["o_orderpriority"], ["payload"], ["o_orderkey"]).select("o_orderkey", "record_id")


@query("SELECT o_orderkey, i AS ordinal, CASE WHEN i = 0 THEN o_orderstatus ELSE o_orderpriority END AS item FROM orders CROSS JOIN (SELECT unnest([0, 1]) AS i)")
def nested_items(spark, d):
    items = F.array(F.struct(F.col("o_orderstatus").alias("item")), F.struct(F.col("o_orderpriority").alias("item")))
    own = F.struct(F.lit("never").alias("item"))
    return project.rows_of(t(spark, d, "orders").withColumn("items", project.loads_or_self(items, own)), "items", ["o_orderkey"])


@query("SELECT c_custkey, c_mktsegment AS unresolved, CASE WHEN c_custkey % 2 = 0 THEN '[\"old' || c_custkey || '\"]' END AS legacy, CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 2 END AS n FROM customer")
def extension_maps(spark, d):
    legacy = F.when(F.col("c_custkey") % 2 == 0, F.array(F.concat(F.lit("old"), "c_custkey"))).otherwise(F.array().cast("array<string>"))
    made = project.extensions("shop", F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("nothing"), F.lit(None)), legacy, F.create_map(F.lit("segment_id"), F.col("c_mktsegment")))
    x = F.col("e.shop")
    return t(spark, d, "customer").withColumn("e", made).select("c_custkey", F.get_json_object(x["unresolved_references"], "$.segment_id").alias("unresolved"), x["legacy_ids"].alias("legacy"), F.size(x).alias("n"))


@query(f"""
SELECT s_name AS major_slug, 'Full ' || k AS major_name, CAST(k AS VARCHAR) AS major_code, 'p' || k AS program_id, 'Program ' || k AS program_name,
  'http://plan.example.com/' || n_name AS plan_url, CASE WHEN n_name < 'M' THEN 'ok' ELSE 'error' END AS plan_status, CASE WHEN n_name < 'M' THEN 7 END::BIGINT AS size FROM {_SUPPLIERS} WHERE odd
""")
def plan_manifest(spark, d):
    resolved = t(spark, d, "nation").where("n_name < 'M'").select(F.concat(F.lit("http://plan.example.com/"), "n_name").alias("plan_url"), F.lit("ok").alias("plan_status"), F.lit("x").alias("resolved_url"), F.lit("y").alias("local_path"), F.lit(7).cast("long").alias("size"), F.lit("z").alias("sha256"), F.lit("pdf").alias("mime_type"))
    found = cards.plan_manifest(_cards(spark, d), resolved)
    return found.select("major_slug", "major_name", "major_code", "program_id", "program_name", "plan_url", "plan_status", "size")


def _level(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders as disciplines, their lines as loads."""
    n = lambda c, k: F.when(F.col(c) % k > 0, (F.col(c) % k).cast("double"))
    orders = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("document_id"), F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("name"), F.lit("").alias("department"), F.lit(1.0).alias("credits"), F.lit(36.0).alias("hours"), n("o_orderkey", 2).alias("lecture"), n("o_orderkey", 3).alias("seminar"), F.lit(None).cast("double").alias("lab"), n("o_custkey", 2).alias("independent_or_other"))
    lines = t(spark, d, "lineitem").select(F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("string")).alias("id"), F.col("l_orderkey").cast("string").alias("discipline_id"), F.col("l_linenumber").alias("semester"), F.col("l_quantity").cast("double").alias("hours"), F.lit(1.0).alias("credits"))
    return orders, lines


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS source_key, CAST(o_custkey AS VARCHAR) AS document_id, CAST(n AS INTEGER) AS n_loads, first AS semester, CAST(o_orderkey % 2 > 0 AS INTEGER) + CAST(o_orderkey % 3 > 0 AS INTEGER) + CAST(o_custkey % 2 > 0 AS INTEGER) AS n_components
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_linenumber) AS first FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE n IS NOT NULL
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), 0, NULL, CAST(o_orderkey % 2 > 0 AS INTEGER) + CAST(o_orderkey % 3 > 0 AS INTEGER) + CAST(o_custkey % 2 > 0 AS INTEGER) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def semantic_source_rows(spark, d):
    return semantic.source_rows(*_level(spark, d)).select("source_key", "document_id", F.size("semester_loads").alias("n_loads"), "semester", F.size("components").alias("n_components"))


@query("""
SELECT type, source_url IS NOT NULL AS located, n FROM (
  SELECT 'discipline' AS type, CASE WHEN o_custkey % 4 > 0 THEN 'u' END AS source_url, count(*) AS n FROM orders GROUP BY 2
  UNION ALL SELECT 'semester_load', CASE WHEN o_custkey % 4 > 0 THEN 'u' END, count(*) FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY 2
  UNION ALL SELECT 'discipline_entity', CASE WHEN c % 4 > 0 THEN 'u' END, count(*) FROM (SELECT o_orderpriority, arg_min(o_custkey, CAST(o_orderkey AS VARCHAR)) AS c FROM orders GROUP BY 1) GROUP BY 2)
UNION ALL SELECT 'load_of', true, count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey UNION ALL SELECT 'resolved_to', true, count(*) FROM orders
""")
def semantic_graph(spark, d):
    disciplines, loads = _level(spark, d)
    aliases = disciplines.select(F.col("id").alias("source_id"), F.col("name").alias("entity_id"))
    known = t(spark, d, "customer").where("c_custkey % 4 > 0").select(F.col("c_custkey").cast("string").alias("document_id"), F.lit("u").alias("source_url"))
    objects, links = semantic.objects_and_links(disciplines, loads, aliases, known)
    counted = objects.groupBy("type", F.col("source_url").isNotNull().alias("located")).agg(F.count("*").alias("n"))
    return counted.unionByName(links.groupBy(F.col("relation").alias("type")).agg(F.count("*").alias("n")).withColumn("located", F.lit(True)))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0")
def semantic_subset(spark, d):
    made = F.create_map(F.lit("a"), F.create_map(F.lit("x"), F.lit("1")), F.lit("b"), F.create_map(F.lit("semantic_source_id"), F.when(F.col("c_custkey") % 3 == 0, "s").when(F.col("c_custkey") % 3 == 1, "")))
    return semantic.of_semantic_source(t(spark, d, "customer").withColumn("extensions", made)).select("c_custkey")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS legacy_id, CAST(o_custkey AS VARCHAR) AS canonical_id, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS reason FROM orders")
def migrated_aliases(spark, d):
    rows = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("legacy_id"), F.col("o_custkey").cast("string").alias("canonical_id"))
    old = rows.where("cast(legacy_id as long) % 3 <> 0 or cast(legacy_id as long) % 2 = 0").withColumn("reason", F.lit("old"))
    return relations.alias_union(old, rows.where("cast(legacy_id as long) % 3 = 0").withColumn("reason", F.lit("new")))


@query("SELECT o_orderstatus, CASE WHEN count(x) > 0 THEN bool_and(x) END AS verdict, CAST(NULL AS DOUBLE) AS of_text, sum(o_totalprice) AS of_number FROM (SELECT *, CASE WHEN o_orderstatus = 'O' THEN o_orderkey > 0 WHEN o_orderstatus = 'F' THEN o_orderkey % 2 = 0 END AS x FROM orders) GROUP BY 1")
def known_verdicts(spark, d):
    known = F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey") > 0).when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 2 == 0)
    return t(spark, d, "orders").groupBy("o_orderstatus").agg(integrity.verdict(known).alias("verdict"), F.sum(numbers.strict_number(F.col("o_orderstatus"))).alias("of_text"), F.sum(numbers.strict_number(F.col("o_totalprice"))).alias("of_number"))


@query("SELECT 'customer' AS entity_type, 'old' || c_custkey AS legacy_id, CAST(c_custkey AS VARCHAR) AS canonical_id FROM customer WHERE c_custkey % 2 = 0")
def stored_aliases(spark, d):
    at = scratch(spark)
    rows = t(spark, d, "customer").select(F.lit(" customer").alias("entity_type"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("old"), "c_custkey")).alias("legacy_id"), F.col("c_custkey").cast("string").alias("canonical_id"))
    snapshots.write_aliases(rows, at)
    return snapshots.read_aliases(spark, at).unionByName(snapshots.read_aliases(spark, f"{at}/absent"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'second' ELSE 'first' END AS fingerprint, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS run FROM orders")
def merged_ledger(spark, d):
    at, orders = scratch(spark), t(spark, d, "orders").select("o_orderkey")
    snapshots.mark(orders.withColumn("fingerprint", F.lit("first")), at, "o_orderkey", "fingerprint", 1)
    snapshots.mark(orders.where("o_orderkey % 2 = 0").withColumn("fingerprint", F.lit("second")), at, "o_orderkey", "fingerprint", 2)
    return snapshots.read_ledger(spark, at, "o_orderkey")


@query("SELECT r_name, 'r' || r_regionkey || '.json' AS file, (SELECT count(*) FROM region) AS n_files FROM region")
def replayed_files(spark, d):
    at = scratch(spark)
    for r in t(spark, d, "region").collect():  # a file for each of the five regions
        snapshots.write_text(spark, f"{at}/r{r.r_regionkey}.json", f'{{"r_name": "{r.r_name}"}}')
    return files.replayed(spark, f"{at}/*.json", "r_name string").join(F.broadcast(files.folder_stats(spark, at).select("n_files")))


@query("SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE CAST(p_size AS VARCHAR) LIKE '1%' ORDER BY p_partkey LIMIT 100")
def row_search_json(spark, d):
    from lectern.operators import paging

    found = paging.search(t(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size"), '"P_SIZE":1')
    return paging.page(found, ["p_partkey"], 0, 100, with_total=False)


@query("""
WITH o AS (SELECT o_orderkey AS k, n, CASE WHEN n IS NULL THEN 'missing' ELSE 'ok' END AS status FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey), c AS (
  SELECT 'canonical_document_count_matches_manifest' AS "check", 0 AS n UNION ALL SELECT 'manifest_reference_count_matches_attached', CAST((SELECT count(*) FROM o WHERE k % 31 = 0) > 0 AS INTEGER)
  UNION ALL SELECT 'all_manifest_references_attached' AS "check", count(*) AS n FROM o WHERE k % 31 = 0 UNION ALL SELECT 'all_referenced_files_exist', count(*) FROM o WHERE k % 31 > 0 AND k % 37 = 0
  UNION ALL SELECT 'no_invalid_or_failed_documents', count(*) FROM o WHERE status = 'missing' UNION ALL SELECT 'all_pdf_tables_detected', count(*) FROM o WHERE n IS NULL AND k % 2 = 0
  UNION ALL SELECT 'all_pdf_raw_layout_captured', count(*) FROM o WHERE k % 2 = 0 AND k % 5 = 0 UNION ALL SELECT 'source_sizes_match_metadata', count(*) FROM o WHERE k % 7 = 0
  UNION ALL SELECT 'source_hashes_match_metadata', count(*) FROM o WHERE k % 11 = 0 UNION ALL SELECT 'document_counts_match_materialized_data', count(*) FROM o WHERE k % 13 = 0
  UNION ALL SELECT 'table_counts_match_materialized_data', count(*) FROM o WHERE n IS NOT NULL AND k % 2 = 1 UNION ALL SELECT 'all_table_rows_and_cells_materialized', (SELECT count(*) FROM o WHERE k % 13 = 0) + (SELECT count(*) FROM o WHERE n IS NOT NULL AND k % 2 = 1)
  UNION ALL SELECT 'no_unreferenced_downloads', count(*) FROM o WHERE k % 31 = 0 AND k % 37 > 0 UNION ALL SELECT 'all_manifest_references_valid', count(*) FROM o WHERE k % 17 = 0
) SELECT "check", n = 0 AS passed, CAST(n AS BIGINT) AS n FROM c UNION ALL SELECT 'passed', bool_and(n = 0), CAST(sum(n) AS BIGINT) FROM c
""")
def materialized_checks(spark, d):
    flat = extraction.flatten(written(_documents(spark, d)))
    k = F.col("document_id").cast("long")
    counted = flat["documents"].join(flat["rows"].groupBy("document_id").agg(F.count("*").cast("int").alias("row_count")), "document_id", "left")
    sources = counted.select(
        "document_id", "status", F.when(k % 2 == 0, "pdf").otherwise("docx").alias("kind"), F.lit(9).alias("expected_size"), F.when(k % 7 > 0, 9).alias("source_size"), F.lit("AB").alias("expected_sha256"), F.when(k % 11 > 0, "ab").otherwise("cd").alias("source_sha256"),
        F.when(k % 5 > 0, "text").otherwise(" ").alias("layout_text"), "table_count", F.when(k % 13 == 0, -1).otherwise(F.col("row_count")).alias("row_count"), F.lit(None).cast("int").alias("cell_count"),
    )
    sources = written(sources)
    references = sources.select("document_id", F.concat(F.lit("plans\\"), "document_id").alias("local_path"), F.lit("p").alias("program_id"), F.lit("u").alias("plan_url"), F.lit(None).cast("string").alias("resolved_url"), (k % 17 > 0).alias("valid"))
    found = sources.where(k % 37 > 0).select(F.concat(F.lit("plans/"), "document_id").alias("path"))
    return materialized.validate(sources, flat, references, references.where(k % 31 > 0).drop("valid"), found).select("check", "passed", "n")
