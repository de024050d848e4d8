"""Integrity checks: duplicates, missing ids, reconciliation, collisions, entity resolution, the quality gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions.ids import legacy_id
from lectern.functions.text import normalize_key, stripped

#: Largest difference that still counts as equal.
TOLERANCE = 0.01


def duplicate_ids(df: DataFrame, *key: str) -> DataFrame:
    """(key, n) of keys that occur more than once; empty keys are ignored."""
    there = df
    for k in key:
        there = there.where(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    return there.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def missing_ids(df: DataFrame, key: str) -> Column:
    return F.count_if(F.col(key).isNull() | (F.col(key).cast("string") == ""))


def dataset_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(dataset, n_rows, n_ids, n_missing) of each table, in one pass over each."""
    out = None
    for name, (df, key) in tables.items():
        one = df.agg(F.count("*").alias("n_rows"), F.count_distinct(F.when(F.col(key).cast("string") != "", F.col(key))).alias("n_ids"), missing_ids(df, key).alias("n_missing")).select(F.lit(name).alias("dataset"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def reconcile(declared: DataFrame, key: str, detail: DataFrame, foreign: str, measures: dict[str, tuple[str, Column]], active: Column, tolerance: float = TOLERANCE) -> DataFrame:
    """Declared totals against the sums of their details: `declared` with sum_<name> and diff_<name> for each measure (name: declared column, detail
    expression), n_active and class: exact, unallocated (no active detail) or mismatch. Only declared values that aren't null are compared.
    """
    sums = detail.groupBy(F.col(foreign).alias("_key")).agg(*[F.sum(e).alias(f"sum_{n}") for n, (_, e) in measures.items()], F.count_if(active).alias("n_active"))
    joined = declared.join(sums, F.col(key) == F.col("_key"), "left").drop("_key").fillna(0, [f"sum_{n}" for n in measures] + ["n_active"])
    off = F.lit(False)
    for name, (column, _) in measures.items():
        joined = joined.withColumn(f"diff_{name}", F.col(f"sum_{name}") - F.col(column))
        off = off | F.coalesce(F.abs(F.col(f"diff_{name}")) > tolerance, F.lit(False))
    return joined.withColumn("class", F.when(~off, "exact").when(F.col("n_active") == 0, "unallocated").otherwise("mismatch"))


def differences(reconciled: DataFrame, measures: Sequence[str], tolerance: float = TOLERANCE) -> Column:
    """A map from measure to difference of reconcile()'s rows, with those beyond the tolerance only."""
    every = F.create_map(*[x for m in measures for x in (F.lit(m), reconciled[f"diff_{m}"].cast("double"))])
    return F.map_filter(every, lambda _, d: F.coalesce(F.abs(d) > tolerance, F.lit(False)))


def reconciliation_examples(reconciled: DataFrame, measures: Sequence[str], order: Sequence[Column | str], most: int = 20, tolerance: float = TOLERANCE) -> DataFrame:
    """The first `most` rows of reconcile() that don't agree, unallocated ones first, then in `order`, with their differences. A top-k, so no more than `most` rows leave a task."""
    wrong = reconciled.withColumn("differences", differences(reconciled, measures, tolerance)).where("class <> 'exact'")
    return wrong.orderBy(F.when(F.col("class") == "unallocated", 0).otherwise(1), *order).limit(most)


def first_values(df: DataFrame, key: Sequence[str], value: str, most: int, alias: str = "examples") -> DataFrame:
    """(key, n, alias): the number of different values of each key, nulls left out, and the first `most` of them in order. Only these are collected."""
    once = df.where(F.col(value).isNotNull()).select(*key, value).distinct()
    few = once.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(value))).where(F.col("_r") <= most)
    listed = few.groupBy(*key).agg(F.sort_array(F.collect_list(value)).alias(alias))
    return once.groupBy(*key).agg(F.count("*").alias("n")).join(listed, list(key))


def code_collisions(df: DataFrame, code: str, name: str, most: int = 20, identity: str | None = None) -> DataFrame:
    """(code, n_names, names): codes with several different names, and the first `most` names; with `identity` also ids, the first `most` ids of their rows."""
    coded = df.where(F.col(code).isNotNull() & (F.col(code) != ""))
    found = first_values(coded, [code], name, most, "names").where("n > 1").withColumnRenamed("n", "n_names")
    return found if identity is None else found.join(first_values(coded, [code], identity, most, "ids").drop("n"), code)


def entity_key(identity: str, code: Column, name: Column, place: Column) -> tuple[Column, Column]:
    """(kind, value) of the entity that a row belongs to: by code and name, else by name and department, else the row alone."""
    has = lambda c: c.isNotNull() & (c != "")
    kind = F.when(has(code) & has(name), "code_name").when(has(name) & has(place), "name_department").otherwise("source")
    value = F.when(kind == "code_name", F.concat_ws("|", code, name)).when(kind == "name_department", F.concat_ws("|", name, place)).otherwise(F.col(identity).cast("string"))
    return kind, value


def entity_resolution(df: DataFrame, identity: str, code: Column, name: Column, place: Column) -> DataFrame:
    """(kind, value, n, first_id, last_id): rows that are one entity by code and name, else by name and department, else alone."""
    kind, value = entity_key(identity, code, name, place)
    return df.groupBy(kind.alias("kind"), value.alias("value")).agg(F.count_distinct(identity).alias("n"), F.min(identity).alias("first_id"), F.max(identity).alias("last_id"))


def entity_index(rows: DataFrame, scope: str, most: int = 20) -> dict[str, DataFrame]:
    """entities, aliases, conflicts, collisions and the one-row verification of rows (id, code, name, department, document_id).

    entities: id, kind, value, code, name, status, n (rows), n_documents, names (aliases), conflicts. Keys are compared after normalising, names as they are written, so an entity may have several
    names or codes: it is then ambiguous, and a conflict for each of the two. aliases: source id to entity. collisions: codes that stand for several names, with
    the first `most` names and ids; they are hints and merge nothing. Lists hold names and codes, a few for each entity; ids stay rows, in `aliases`.
    """
    text = lambda c: stripped(F.coalesce(F.col(c), F.lit("")))
    kind, value = entity_key("id", normalize_key(text("code")), normalize_key(text("name")), normalize_key(text("department")))
    keyed = rows.select("id", text("code").alias("code"), text("name").alias("name"), "document_id", kind.alias("kind"), value.alias("value"))
    keyed = keyed.withColumn("entity_id", legacy_id(scope, "entity", F.col("kind"), F.col("value")))
    lists = {c: F.sort_array(F.collect_set(F.nullif(F.col(c), F.lit("")))).alias(f"{c}s") for c in ("name", "code")}
    grouped = keyed.groupBy("entity_id", "kind", "value").agg(*lists.values(), F.count("*").alias("n"), F.count_distinct("document_id").alias("n_documents"))
    clash = F.array_compact(F.array(*[F.when(F.size(f"{c}s") > 1, F.struct(F.lit(f"{c}_conflict").alias("kind"), F.col(f"{c}s").alias("values"))) for c in ("name", "code")]))
    entities = grouped.select(
        F.col("entity_id").alias("id"), "kind", "value", F.coalesce(F.get("codes", F.lit(0)), F.lit("")).alias("code"), F.coalesce(F.get("names", F.lit(0)), F.lit("")).alias("name"), "n", "n_documents",
        F.col("names").alias("aliases"), clash.alias("conflicts"), F.when(F.size(clash) > 0, "ambiguous").otherwise("resolved").alias("status"),
    )
    aliases = keyed.select(F.col("id").alias("source_id"), "entity_id").join(entities.select(F.col("id").alias("entity_id"), "status"), "entity_id")
    conflicts = entities.select(F.col("id").alias("entity_id"), F.explode("conflicts").alias("c")).select("entity_id", "c.kind", "c.values")
    collisions = code_collisions(keyed, "code", "name", most, "id")
    counted = rows.select(F.lit(1).alias("rows"), F.lit(0).alias("mapped"), F.lit(0).alias("doubtful")).unionByName(aliases.select(F.lit(0).alias("rows"), F.lit(1).alias("mapped"), F.when(F.col("status") == "ambiguous", 1).otherwise(0).alias("doubtful")))
    sums = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted.columns])
    verified = sums.select((F.col("rows") == F.col("mapped")).alias("all_mapped"), (F.col("doubtful") == 0).alias("no_ambiguous_entities"), (F.col("rows") == F.col("mapped")).alias("passed"))
    return {"entities": entities, "aliases": aliases, "conflicts": conflicts, "collisions": collisions, "verification": verified}


def histogram(df: DataFrame, c: str, dataset: str) -> DataFrame:
    return df.groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit(dataset).alias("dataset"), "value", "n")


def all_true(c: Column) -> Column:
    """Whether a condition holds for every row; true for no rows."""
    return F.coalesce(F.bool_and(c), F.lit(True))


def gate(counts: DataFrame, checks: DataFrame, required: Sequence[str] = ()) -> dict:
    """The verdict over small tables: `counts` (dataset, n_rows, n_ids, n_missing), `checks` (name, passed). Errors block, so passed means none."""
    seen = {r.dataset: r for r in counts.collect()}
    errors = [f"{d}: missing ids" for d, r in seen.items() if r.n_missing] + [f"{d}: duplicate ids" for d, r in seen.items() if r.n_ids + r.n_missing < r.n_rows]
    errors += [f"{d}: no rows" for d in required if d not in seen or not seen[d].n_rows]
    errors += [f"check {r.name} failed" for r in checks.collect() if r.passed is False]
    return {"passed": not errors, "errors": sorted(errors), "records": {d: r.n_rows for d, r in seen.items()}}


def metric_sums(metrics: DataFrame) -> DataFrame:
    """One row of the sums of records, warnings, gaps, failures and duration_ms (to three decimals) over capabilities' metrics; what is null, or no column, counts as 0."""
    there = lambda c: F.coalesce(F.sum(c), F.lit(0)) if c in metrics.columns else F.lit(0)
    return metrics.agg(F.lit(0).alias("_none"), *[there(c).cast("long").alias(c) for c in ("records", "warnings", "gaps", "failures")], F.round(there("duration_ms").cast("double"), 3).alias("duration_ms")).drop("_none")


def verdict(c: Column) -> Column:
    """Whether all known checks passed; null if none is known."""
    return F.bool_and(c)
