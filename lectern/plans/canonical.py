"""Canonical datasets from source records, their object graph, quality report and id aliases.

Source records: source_key, name, code, ... and provenance, a struct with at least source_key, source_url and raw_snapshot_path. Canonical rows: id, scope, the values,
references as <field>_id, field_meta, extensions and provenance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.ids import source_keys, stable_id
from lectern.functions.lineage import written
from lectern.functions.numbers import positive_int
from lectern.functions.text import canonical_url, first_text, is_present, stripped
from lectern.operators import integrity, resolve
from lectern.operators.project import array_or, extensions, field_meta, relation_id
from lectern.operators.relations import broken, first_wins, kept

#: Reference field -> type of its target.
TARGETS = {
    "study_direction_id": "study_direction", "program_id": "program", "department_id": "department", "faculty_id": "faculty", "curriculum_id": "curriculum",
    "discipline_id": "discipline", "semester_id": "semester",
}


def materialize(source: DataFrame, scope: str, kind: str, values: Sequence[str], references: dict[str, tuple[str, str]] | None = None, capabilities: dict[str, bool] | None = None) -> DataFrame:
    """Canonical rows of one kind. `references`: field -> (key column, target kind); a key whose target kind isn't enabled is kept as unresolved in the extensions. The id
    comes from the source key, else the code, else the name."""
    enabled = capabilities or {}
    has = lambda c: F.col(c) if c in source.columns else F.lit(None).cast("string")
    key = first_text(has("source_key"), has("code"), has("name"))
    ids, unresolved = {}, []
    for field, (column, target) in (references or {}).items():
        ids[field], rest = relation_id(F.col(column), scope, target, enabled.get(target, True))
        unresolved += [F.lit(field), rest]
    open_ = F.map_filter(F.create_map(*unresolved), lambda k, v: v.isNotNull()) if unresolved else F.create_map().cast("map<string,string>")
    raw = has("raw") if "raw" in source.columns else F.create_map().cast("map<string,string>")
    legacy = F.coalesce(F.col("legacy_ids"), F.array().cast("array<string>")) if "legacy_ids" in source.columns else F.array().cast("array<string>")
    return source.select(
        stable_id(scope, kind, key).alias("id"), F.lit(scope).alias("scope"), *values, *[c.alias(f) for f, c in ids.items()],
        field_meta(**{v: F.col(v) for v in values}).alias("field_meta"), extensions(scope, F.coalesce(raw, F.create_map().cast("map<string,string>")), legacy, open_).alias("extensions"),
        F.col("provenance") if "provenance" in source.columns else F.lit(None).cast("struct<source_key:string,source_url:string,raw_snapshot_path:string>").alias("provenance"),
    )


def programs(source: DataFrame, scope: str, order: Sequence[str], capabilities: dict[str, bool] | None = None) -> tuple[DataFrame, DataFrame]:
    """(programs, study_directions): a direction for each key that programs name, described by the first program in `order`."""
    keyed = source.withColumn("direction_key", first_text(F.col("study_direction_key"), F.col("code"), F.col("name")))
    rows = materialize(keyed, scope, "program", ["name", "code"], {"study_direction_id": ("direction_key", "study_direction")}, capabilities)
    first = first_wins(keyed.where("direction_key <> ''"), ["direction_key"], order)
    named = first.select(
        F.col("direction_key").alias("source_key"), first_text(F.col("study_direction_name"), F.col("direction_key")).alias("name"), first_text(F.col("study_direction_code"), F.col("direction_key")).alias("code"), "provenance"
    )
    return rows, materialize(named, scope, "study_direction", ["name", "code"])


LOADS = "array<struct<semester:string,total_hours:double,credits:double,components:map<string,double>>>"


def curricula(rows: DataFrame, scope: str, order: Sequence[str], chain: list[tuple[str, tuple]] | None = None, hours_per_credit: float = 36) -> dict[str, DataFrame]:
    """disciplines, semesters and semester_loads from curriculum rows.

    rows: curriculum_key, code, discipline, name, department, section_path, semester (text), total_hours, credits, components (map), semester_loads (LOADS), provenance and
    the `order` columns. A row counts if `discipline` (or `name`, where discipline is null) isn't blank. Hours are resolved by the chain: published total, sum of
    components, credits. A load without a positive integral semester is left out; a row without loads is its own load. The first curriculum that names a semester describes it.
    """
    named = rows.where(stripped(F.coalesce("discipline", "name", F.lit(""))) != "").withColumn("title", first_text(F.col("discipline"), F.col("name")))
    keyed = source_keys(named, ["curriculum_key", "code", "title", "department", "section_path"], [c for c in ("code", "title", "department", "section_path", "semester", "total_hours", "credits", "components")], order)
    keyed = keyed.withColumn("discipline_key", F.concat_ws(":", "curriculum_key", F.lit("discipline"), "source_key"))

    def hours(total: Column, components: Column, credits: Column) -> Column:
        specs = chain or [("direct", (total,)), ("sum_components", (components,)), ("credits_to_hours", (credits, hours_per_credit))]
        return resolve.build_chain(specs)

    resolved = keyed.withColumn("hours", hours(F.col("total_hours"), F.col("components"), F.col("credits"))).withColumn("id", stable_id(scope, "discipline", F.col("discipline_key")))
    resolved = resolved.withColumn("curriculum_id", stable_id(scope, "curriculum", F.col("curriculum_key")))
    disciplines = resolved.select(
        "id", F.lit(scope).alias("scope"), F.col("title").alias("name"), "code", F.col("hours.value").alias("total_hours"), F.col("hours.status").alias("hours_status"), F.col("hours.method").alias("hours_method"),
        F.col("hours.confidence").alias("hours_confidence"), F.col("hours.warnings").alias("hours_warnings"), "credits", "semester", "curriculum_id", "provenance",
    )
    own = F.struct(F.col("semester").cast("string").alias("semester"), "total_hours", "credits", "components")
    spread = resolved.select(F.col("id").alias("discipline_id"), "curriculum_id", "discipline_key", "components", "provenance", *order, F.posexplode(array_or(F.col("semester_loads"), F.array(own)).cast(LOADS)).alias("load_no", "load"))
    loads = spread.withColumn("number", positive_int(F.col("load.semester"))).where("number is not null")
    load_hours = hours(F.col("load.total_hours"), F.coalesce(F.col("load.components"), F.col("components")), F.col("load.credits"))
    semester_loads = loads.select(
        stable_id(scope, "semester_load", F.concat_ws(":", "discipline_key", F.lit("semester"), F.col("number").cast("string"))).alias("id"), F.lit(scope).alias("scope"), "discipline_id", "curriculum_id",
        stable_id(scope, "semester", F.col("number")).alias("semester_id"), "number", load_hours["value"].alias("hours"), F.col("load.credits").alias("credits"), "provenance",
    )
    first = first_wins(loads, ["number"], [*order, "load_no"])
    semesters = first.select(stable_id(scope, "semester", F.col("number")).alias("id"), F.lit(scope).alias("scope"), "number", "provenance")
    return {"disciplines": disciplines, "semesters": semesters, "semester_loads": semester_loads}


def ontology(records: dict[str, tuple[str, DataFrame]], scope: str, capabilities: dict[str, bool] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(objects, links, broken_links) of datasets {name: (type, canonical rows)}.

    objects: id, type, datasets. Every row links to its scope and to each reference it has, but for targets that aren't enabled. Links are not deduplicated, objects are.
    """
    enabled, objects, edges = capabilities or {}, None, None
    for name, (kind, df) in records.items():
        mine = df.where(is_present(F.col("id"))).select("id", F.lit(kind).alias("type"), F.lit(name).alias("dataset"))
        objects = mine if objects is None else objects.unionByName(mine)
        fields = [("scope", "university", stable_id(scope, "university", F.col("scope")))] + [(f, t, F.col(f)) for f, t in TARGETS.items() if f in df.columns and enabled.get(t, True)]
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("type"), F.lit(t).alias("target_type"), c.alias("to")) for f, t, c in fields]))
        out = df.where(is_present(F.col("id"))).select(F.col("id").alias("from"), each.alias("e")).select("from", "e.*").where(is_present(F.col("to")))
        edges = out if edges is None else edges.unionByName(out)
    edges = edges.select(F.concat_ws(":", "from", "type", "to").alias("link_id"), "type", "from", "to", "target_type")
    merged = objects.groupBy("id").agg(F.min_by("type", "dataset").alias("type"), F.sort_array(F.collect_set("dataset")).alias("datasets"))
    return merged, kept(edges, "to", merged, "id"), broken(edges, "to", merged, "id")


def has_locator(provenance: str = "provenance") -> Column:
    """The record names a place to look it up: a web or file address."""
    return F.coalesce(F.col(f"{provenance}.source_url").rlike(r"(?i)^(https?://[^/\s]+|file:)"), F.lit(False)) & is_present(F.col(f"{provenance}.source_key"))


def quality_report(records: dict[str, DataFrame], scope: str, capabilities: dict[str, bool], primary: dict[str, str], links: DataFrame | None = None, states: dict[str, str] | None = None, allow_partial: Sequence[str] = (), warnings: dict[str, Sequence[str]] | None = None, gaps: dict[str, Sequence[str]] | None = None, metrics: DataFrame | None = None) -> dict:
    """The verdict: a status for each capability (not_supported, failed, not_published, degraded, published), counts, checks and errors; passed if there are none. One
    aggregate for each dataset reaches the driver. metrics (records, failures, duration_ms of each capability) are told as sums, next to the numbers of warnings and gaps; an entry for a capability
    that isn't known is an error, as is a blank warning or gap."""
    states, errors, counts, checks = states or {}, [], {}, {"records_scoped": True, "provenance_present": True, "record_ids_unique": True, "record_ids_present": True}
    for name, df in records.items():
        located = integrity.all_true(has_locator()) if "provenance" in df.columns and name != "universities" else F.lit(True)
        known = F.when(is_present(F.col("id")), F.col("id"))
        scoped = integrity.all_true(F.col("scope").eqNullSafe(scope))
        row = df.agg(F.count("*").alias("n"), F.count(known).alias("there"), F.count_distinct(known).alias("distinct"), scoped.alias("scoped"), located.alias("located")).first()
        counts[name] = row.n
        checks["records_scoped"] &= row.scoped
        checks["provenance_present"] &= row.located
        checks["record_ids_unique"] &= row.there == row.distinct
        checks["record_ids_present"] &= row.there == row.n
    orphans = links.count() if links is not None else 0
    statuses = {}
    for name, supported in capabilities.items():
        if not supported:
            statuses[name] = "not_supported"
        elif states.get(name) in ("failed", "not_published"):
            statuses[name] = states[name]
        elif not counts.get(primary.get(name, name)):
            partial = states.get(name) == "degraded" and name in allow_partial
            statuses[name] = "degraded" if partial else "not_published"
            errors += [] if partial else [f"{name}: no records"]
        else:
            statuses[name] = states.get(name, "published")
    errors += [name for name, passed in checks.items() if not passed] + ([f"{orphans} orphan links"] if orphans else [])
    told, open_ = ({k: list(v) for k, v in (x or {}).items()} for x in (warnings, gaps))
    for kind, entries in (("warnings", told), ("gaps", open_)):
        errors += [f"{kind} of {name}, which isn't a capability" for name in entries if name not in capabilities]
        errors += [f"blank {kind} of {name}" for name, texts in entries.items() if any(not x.strip() for x in texts)]
    sums = integrity.metric_sums(metrics).first().asDict() if metrics is not None else {"records": 0, "failures": 0, "duration_ms": 0.0}
    sums |= {"warnings": sum(map(len, told.values())), "gaps": sum(map(len, open_.values()))}
    return {"passed": not errors, "errors": errors, "capability_status": statuses, "counts": counts, "checks": checks | {"orphan_links": orphans}, "warnings": sums["warnings"], "metrics": sums}


def unresolved_references(df: DataFrame, scope: str) -> DataFrame:
    """(id, field, source_key) of references kept as unresolved."""
    text = F.element_at(F.element_at("extensions", F.lit(scope)), F.lit("unresolved_references"))
    return df.select("id", F.explode(F.from_json(text, "map<string,string>")).alias("field", "source_key"))


def _aliases(previous: DataFrame, current: DataFrame, existing: DataFrame | None) -> DataFrame:
    """(entity_type, legacy_id, canonical_id) of all sources of aliases, repeated ones too."""
    explicit = current.select("entity_type", F.explode("legacy_ids").alias("legacy_id"), F.col("id").alias("canonical_id"))

    def keyed(df: DataFrame, name: str) -> DataFrame:
        there = df.where(is_present(F.col("source_key"))).select("entity_type", stripped(F.col("source_key")).alias("k"), F.col("id").alias(name))
        return there.withColumn("k", canonical_url("k"))

    moved = keyed(previous, "legacy_id").join(keyed(current, "canonical_id"), ["entity_type", "k"]).drop("k")
    every = explicit.unionByName(moved)
    if existing is not None:
        every = every.unionByName(existing.select("entity_type", "legacy_id", "canonical_id"))
    return every.where(is_present(F.col("legacy_id")) & is_present(F.col("canonical_id")) & (F.col("legacy_id") != F.col("canonical_id")))


def id_aliases(previous: DataFrame, current: DataFrame, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(aliases, conflicts), both (entity_type, legacy_id, ...): explicit legacy ids of current rows, and earlier ids of rows whose source key stayed. previous and current: entity_type,
    id, source_key, legacy_ids (current only). One legacy id with several targets is a conflict, which a publication must refuse."""
    grouped = _aliases(previous, current, existing).groupBy("entity_type", "legacy_id").agg(F.min("canonical_id").alias("canonical_id"), F.count_distinct("canonical_id").alias("n"))
    return grouped.where("n = 1").drop("n"), grouped.where("n > 1").select("entity_type", "legacy_id", "n")


def checked_aliases(previous: DataFrame, current: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The aliases of id_aliases(); an error that names some conflicts, if there are any. Aliases are written once, and what is given back is read from there."""
    ends = _aliases(previous, current, existing).groupBy("entity_type", "legacy_id").agg(F.min("canonical_id").alias("canonical_id"), F.max("canonical_id").alias("_last"))
    grouped = written(ends.withColumn("_one", F.col("canonical_id") == F.col("_last")).drop("_last"))
    some = [f"{r.entity_type} {r.legacy_id}" for r in grouped.where("not _one").orderBy("entity_type", "legacy_id").limit(20).collect()]
    if some:
        raise ValueError(f"aliases with several targets: {', '.join(some)}")
    return grouped.drop("_one")
