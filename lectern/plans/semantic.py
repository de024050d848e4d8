"""Quality of curriculum tables after their reading: the typed contract, the semantic report, and what blocks a publication.

rows: id, source_cell_ids. disciplines: id, code, name, department, part_type, credits, audited_hours, hours. loads: id, discipline_id, semester, active, has_numeric_load, control,
control_tokens, raw (map from field to text), hours. tables: table_id, document_id. schemas: document_id, semester_count, warnings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import clean, is_present, stripped
from lectern.functions.tokens import control_tokens
from lectern.operators.integrity import duplicate_ids, first_values, reconcile
from lectern.operators.relations import broken

EXAMPLES = 20
#: Fields of a load that hold numbers.
NUMERIC = ("credits", "hours", "audited_hours", "independent_or_other_hours")


def _named(rule: str, df: DataFrame, name: Column | str = "id") -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), (F.col(name) if isinstance(name, str) else name).cast("string").alias("name"))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def contract_violations(rows: DataFrame, disciplines: DataFrame, loads: DataFrame) -> DataFrame:
    """(rule, severity, name) of what breaks the typed contract. Repeated ids are named once, other rows each; empty ids count for the rules about content only. A part type that is unknown is a warning."""
    subject = ~is_present(stripped(F.col("code"))) | ~is_present(stripped(F.col("name")))
    errors = [
        _named("unique_discipline_ids", duplicate_ids(disciplines, "id")),
        _named("discipline_code_and_name_present", disciplines.where(F.coalesce(subject, F.lit(True)))),
        _named("semester_loads_reference_disciplines", broken(loads, "discipline_id", disciplines, "id")),
        _named("unique_semester_load_ids", duplicate_ids(loads, "id")),
        _named("semantic_rows_have_source_cells", rows.where(F.coalesce(F.size("source_cell_ids"), F.lit(0)) <= 0)),
    ]
    warnings = _named("known_part_type", disciplines.where("part_type = 'unknown'"))
    return _all(errors).withColumn("severity", F.lit("error")).unionByName(warnings.withColumn("severity", F.lit("warning")))


RULES = ("unique_discipline_ids", "discipline_code_and_name_present", "semester_loads_reference_disciplines", "unique_semester_load_ids", "semantic_rows_have_source_cells")


def anomalies(tables: DataFrame, schemas: DataFrame, rows: DataFrame, disciplines: DataFrame, loads: DataFrame, read: DataFrame) -> DataFrame:
    """(rule, name): what fails each of the twelve semantic checks. `read` (table_id) are the tables that were read."""
    spread = loads.select("id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.element_at("raw", F.lit(f)), F.lit("")).alias("text")) for f in NUMERIC])).alias("x"))
    leaks = spread.where(F.size(control_tokens(F.col("x.text"))) > 0)
    told = clean(F.col("control"))
    sums = reconcile(disciplines.select("id", F.col("hours").alias("declared")), "id", loads.where("active"), "discipline_id", {"hours": ("declared", F.col("hours"))}, F.col("active"))
    return _all([
        _named("all_curriculum_tables_read", tables.join(read.select("table_id"), "table_id", "left_anti").select("table_id").distinct(), "table_id"),
        _named("all_curriculum_documents_have_schema", tables.join(schemas.select("document_id"), "document_id", "left_anti"), "table_id"),
        _named("discipline_ids_unique", duplicate_ids(disciplines, "id")),
        _named("discipline_subject_fields_present", disciplines.where(~is_present(F.col("code")) | ~is_present(F.col("name")))),
        _named("semester_loads_reference_disciplines", broken(loads, "discipline_id", disciplines, "id")),
        _named("semester_load_ids_unique", duplicate_ids(loads, "id")),
        _named("all_semantic_rows_reference_cells", rows.where(F.coalesce(F.size("source_cell_ids"), F.lit(0)) <= 0)),
        _named("allocated_semester_totals_reconcile", sums.where("class = 'mismatch'")),
        _named("no_control_tokens_in_numeric_semester_fields", leaks, F.concat_ws(":", "id", "x.field")),
        _named("all_control_fields_classified", loads.where((told != "") & (F.coalesce(F.size("control_tokens"), F.lit(0)) <= 0))),
        _named("no_unexplained_active_semester_rows", loads.where(F.col("active") & ~F.col("has_numeric_load") & (told == ""))),
        _named("no_schema_warnings", schemas.where("size(warnings) > 0"), "document_id"),
    ])


CHECKS = (
    "all_curriculum_tables_read", "all_curriculum_documents_have_schema", "discipline_ids_unique", "discipline_subject_fields_present", "semester_loads_reference_disciplines", "semester_load_ids_unique",
    "all_semantic_rows_reference_cells", "allocated_semester_totals_reconcile", "no_control_tokens_in_numeric_semester_fields", "all_control_fields_classified", "no_unexplained_active_semester_rows", "no_schema_warnings",
)


def report(tables: DataFrame, schemas: DataFrame, rows: DataFrame, disciplines: DataFrame, loads: DataFrame, read: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """(check, passed, n, examples): the twelve checks and the five of the contract, how many different things fail each and the first `most` of them, and the row "passed" for all together."""
    spark = tables.sparkSession
    found = anomalies(tables, schemas, rows, disciplines, loads, read)
    contract = contract_violations(rows, disciplines, loads).where("severity = 'error'").select(F.concat(F.lit("curriculum_contract_"), "rule").alias("rule"), "name")
    failed = first_values(found.unionByName(contract).withColumn("name", F.coalesce("name", F.lit(""))), ["rule"], "name", most)
    names = spark.createDataFrame([(c,) for c in (*CHECKS, *(f"curriculum_contract_{r}" for r in RULES))], "check string")
    none = F.array().cast("array<string>")
    each = names.join(failed, F.col("check") == F.col("rule"), "left").select("check", F.col("rule").isNull().alias("passed"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("examples", none).alias("examples"))
    whole = each.agg(F.bool_and("passed").alias("passed"), F.sum("n").alias("n")).select(F.lit("passed").alias("check"), "passed", "n", none.alias("examples"))
    return each.unionByName(whole)


def source_gaps(disciplines: DataFrame, loads: DataFrame) -> DataFrame:
    """(gap, n): what the source leaves out; no failure."""
    sums = reconcile(disciplines.select("id", F.col("hours").alias("declared")), "id", loads.where("active"), "discipline_id", {"hours": ("declared", F.col("hours"))}, F.col("active"))
    counted = disciplines.agg(
        F.count_if(F.col("credits").isNull()).alias("disciplines_without_total_credits"), F.count_if(F.col("audited_hours").isNull()).alias("disciplines_without_audited_hours"),
        F.count_if(~is_present(F.col("department"))).alias("disciplines_without_department"), F.count_if(F.col("part_type") == "unknown").alias("disciplines_with_unknown_part_type"),
    )
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("gap"), F.col(c).alias("n")) for c in counted.columns])).alias("x")
    unallocated = sums.agg(F.count_if(F.col("class") == "unallocated").alias("n")).select(F.lit("unallocated_total_without_semester_rows").alias("gap"), "n")
    return counted.select(pairs).select("x.*").unionByName(unallocated)


def failures(curricula: DataFrame) -> DataFrame:
    """(id, namespace, kind, detail) of what in curricula (id, extensions: map from namespace to a map of JSON texts) blocks a publication: reports that did not pass, and any warnings."""
    spaces = curricula.select("id", F.explode("extensions").alias("namespace", "x"))
    of = lambda name: F.element_at("x", F.lit(name))
    several = F.from_json(of("semantic_reports"), "array<string>")
    reports = spaces.select("id", "namespace", F.explode(F.when(several.isNotNull(), several).otherwise(F.array(of("semantic_report")))).alias("detail"))
    bad = reports.where(F.from_json("detail", "verification struct<passed:boolean>")["verification"]["passed"] == F.lit(False)).select("id", "namespace", F.lit("report").alias("kind"), "detail")
    warned = spaces.where(F.size(F.from_json(of("semantic_warnings"), "array<string>")) > 0).select("id", "namespace", F.lit("warnings").alias("kind"), of("semantic_warnings").alias("detail"))
    return bad.unionByName(warned)


COMPONENTS = ("lecture", "seminar", "lab", "independent_or_other")


def source_rows(disciplines: DataFrame, loads: DataFrame) -> DataFrame:
    """Disciplines (id, document_id, code, name, department, credits, hours and the COMPONENTS) as source rows of a curriculum: components as a map without nulls, semester_loads in order of the semester, and
    the first load's semester. A discipline has as many loads as semesters."""
    nested = loads.groupBy(F.col("discipline_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct(F.col("semester").cast("int").alias("semester"), "hours", "credits"))).alias("semester_loads"))
    parts = F.map_filter(F.create_map(*[x for c in COMPONENTS for x in (F.lit(c), F.col(c))]), lambda k, v: v.isNotNull())
    joined = disciplines.join(nested, "id", "left")
    none = F.array().cast("array<struct<semester:int,hours:double,credits:double>>")
    return joined.select(
        F.col("id").alias("source_key"), "document_id", "code", "name", "department", "credits", F.col("hours").alias("total_hours"), parts.alias("components"), F.coalesce("semester_loads", none).alias("semester_loads"),
        F.get("semester_loads", F.lit(0))["semester"].alias("semester"),
    )


def of_semantic_source(rows: DataFrame, extensions: str = "extensions", field: str = "semantic_source_id") -> DataFrame:
    """Rows that any namespace of `extensions` (a map of maps) traces to a semantic source."""
    return rows.where(F.exists(F.map_values(extensions), lambda x: F.coalesce(is_present(F.element_at(x, F.lit(field))), F.lit(False))))


def objects_and_links(disciplines: DataFrame, loads: DataFrame, aliases: DataFrame, provenance: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(objects, links) that the semantic level adds to a graph. disciplines (id, document_id), loads (id, discipline_id), aliases (source_id, entity_id), provenance (document_id, source_url).

    objects: id, type, document_id, source_url (from the document's provenance, null if it has none). An entity lies in the document of its first discipline. links: source_id, relation, target_id;
    those whose ends aren't both among the objects are left out.
    """
    placed = aliases.join(disciplines.select(F.col("id").alias("source_id"), "document_id"), "source_id", "left")
    entities = placed.groupBy(F.col("entity_id").alias("id")).agg(F.min_by("document_id", "source_id").alias("document_id"))
    of_loads = loads.select("id", "discipline_id").join(disciplines.select(F.col("id").alias("discipline_id"), "document_id"), "discipline_id", "left")
    kinds = {"discipline": disciplines, "semester_load": of_loads, "discipline_entity": entities}
    objects = _all([df.select("id", F.lit(kind).alias("type"), "document_id") for kind, df in kinds.items()]).join(provenance.select("document_id", "source_url"), "document_id", "left")
    ends = [loads.select(F.col("id").alias("source_id"), F.lit("load_of").alias("relation"), F.col("discipline_id").alias("target_id")), aliases.select("source_id", F.lit("resolved_to").alias("relation"), F.col("entity_id").alias("target_id"))]
    known = objects.select(F.col("id").alias("_id"))
    both = _all(ends).join(known, F.col("source_id") == F.col("_id"), "left_semi").join(known, F.col("target_id") == F.col("_id"), "left_semi")
    return objects.select("id", "type", "document_id", "source_url"), both


def write(datasets: dict[str, DataFrame], path: str) -> None:
    """Rows, disciplines, entities, loads, schemas and reports, each under its name."""
    for name, df in datasets.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
