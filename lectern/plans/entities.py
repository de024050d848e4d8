"""Typed canonical rows, one projection for each kind of entity, laid down as tables of fields."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.ids import stable_id
from lectern.functions.text import is_present, stripped
from lectern.operators.project import extensions, published_meta

PROVENANCE = "struct<source_key:string,source_url:string,raw_snapshot_path:string>"
META = "map<string,struct<status:string,method:string,confidence:double,warnings:array<string>>>"


@dataclass(frozen=True)
class Entity:
    """What a kind of entity has: `values` (field: type), `references` (field: key column, target kind, capability that target needs), `meta` (fields whose presence is told), `key` (columns of which the first
    that isn't empty makes the id) or `parts` (columns that make it together), and `always` (references that need no capability: field: target kind, columns tried in turn)."""

    values: Mapping[str, str]
    meta: tuple[str, ...]
    key: tuple[str, ...] = ()
    parts: tuple[str, ...] = ()
    references: Mapping[str, tuple[str, str, str]] = field(default_factory=dict)
    always: Mapping[str, tuple[str, tuple[str, ...]]] = field(default_factory=dict)


_NAMED = {"name": "string", "code": "string"}
_OF_PROGRAM = {"program_id": ("program_key", "program", "programs"), "study_direction_id": ("study_direction_key", "study_direction", "programs")}
#: Kinds and their fields (fixed values).
ENTITIES: dict[str, Entity] = {
    "university": Entity({"name": "string"}, ("name",), key=("source_key",)),
    "study_direction": Entity(_NAMED, ("name", "code"), key=("source_key",)),
    "program": Entity(
        {**_NAMED, "description": "string", "study_plan_url": "string"}, ("name", "code"), key=("source_key", "code", "name"), references={"department_id": ("department_key", "department", "departments")},
        always={"study_direction_id": ("study_direction", ("study_direction_key", "code", "name"))},
    ),
    "faculty": Entity(_NAMED, ("name", "code"), key=("source_key", "code", "name")),
    "department": Entity(_NAMED, ("name", "code"), key=("source_key", "code", "name"), references={"faculty_id": ("faculty_key", "faculty", "faculties")}),
    "curriculum": Entity({"name": "string", "source_path": "string"}, ("name",), key=("source_key",), references={"program_id": ("program_key", "program", "programs")}),
    "discipline": Entity({**_NAMED, "total_hours": "double", "credits": "double", "semester": "int"}, ("total_hours",), key=("source_key", "name"), references={"curriculum_id": ("curriculum_key", "curriculum", "curricula")}),
    "teacher": Entity({"name": "string", "position": "string", "email": "string"}, ("name",), key=("source_key", "name"), references={"department_id": ("department_key", "department", "departments")}),
    "semester": Entity({"number": "int"}, ("number",), key=("number",)),
    "semester_load": Entity(
        {"hours": "double", "credits": "double"}, ("hours", "credits"), parts=("discipline_key", "semester"), always={"semester_id": ("semester", ("semester",))},
        references={"discipline_id": ("discipline_key", "discipline", "curricula"), "curriculum_id": ("curriculum_key", "curriculum", "curricula")},
    ),
    "admission_requirement": Entity({"subject": "string", "minimum_score": "double", "is_choice": "boolean"}, ("minimum_score",), key=("source_key", "subject"), references=_OF_PROGRAM),
    "tuition_option": Entity({"study_form": "string", "value": "decimal(38,10)", "currency": "string", "term": "string"}, ("value",), key=("source_key", "study_form"), references=_OF_PROGRAM),
}


def _typed(c: Column, kind: str) -> Column:
    """A value of a field's type: text is "" where there is none, anything else null; a text that is no number is none."""
    if kind == "string":
        return F.coalesce(c.cast("string"), F.lit(""))
    boolean = F.typeof(c) == "boolean"
    return c.try_cast(kind) if kind == "boolean" else F.when(~boolean, F.nullif(stripped(c.cast("string")), F.lit("")).try_cast(kind))


def project(kind: str, source: DataFrame, scope: str, capabilities: Mapping[str, bool] | None = None) -> DataFrame:
    """id, scope, the kind's values and references, field_meta, extensions and provenance of source rows; columns that `source` lacks are empty.

    A reference to a kind whose capability is off (`capabilities`, if given; not named is off) is "" and its key is kept under unresolved_references in the extensions, by the name of its column. An empty
    key is "" and nothing more. field_meta tells which fields are published; a discipline's hours come from `resolution`, a struct (value, status, method, confidence, warnings), if there is one.
    """
    spec = ENTITIES[kind]
    has = lambda c: F.col(c) if c in source.columns else F.lit(None).cast("string")
    first = lambda columns: F.coalesce(*[F.nullif(has(c).cast("string"), F.lit("")) for c in columns], F.lit(""))
    resolved = "resolution" in source.columns and "total_hours" in spec.values
    values = {c: _typed(has(c), t) for c, t in spec.values.items()} | ({"total_hours": F.col("resolution.value").cast("double")} if resolved else {})
    references, open_ = {}, []
    for name, (column, target, capability) in spec.references.items():
        on = capabilities is None or capabilities.get(capability, False)
        key = has(column)
        references[name] = F.when(is_present(key), stable_id(scope, target, key)).otherwise("") if on else F.lit("")
        open_ += [] if on else [F.lit(column), F.when(is_present(key), key.cast("string"))]
    for name, (target, columns) in spec.always.items():
        references[name] = stable_id(scope, target, first(columns))
    unresolved = F.map_filter(F.create_map(*open_), lambda _, v: v.isNotNull()) if open_ else F.create_map().cast("map<string,string>")
    raw = F.coalesce(has("raw").cast("map<string,string>") if "raw" in source.columns else F.lit(None).cast("map<string,string>"), F.create_map().cast("map<string,string>"))
    legacy = F.coalesce(has("legacy_ids") if "legacy_ids" in source.columns else F.lit(None).cast("array<string>"), F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    told = {c: F.struct(published_meta(values[c])["status"].alias("status"), F.lit("source").alias("method"), published_meta(values[c])["confidence"].alias("confidence"), none.alias("warnings")) for c in spec.meta}
    if resolved:
        told["total_hours"] = F.struct(F.col("resolution.status").alias("status"), F.col("resolution.method").alias("method"), F.col("resolution.confidence").cast("double").alias("confidence"), F.coalesce("resolution.warnings", none).alias("warnings"))
    identity = stable_id(scope, kind, *[has(c) for c in spec.parts]) if spec.parts else stable_id(scope, kind, first(spec.key))
    provenance = F.col("provenance") if "provenance" in source.columns else F.lit(None).cast(PROVENANCE)
    return source.select(
        identity.alias("id"), F.lit(scope).alias("scope"), *[c.alias(n) for n, c in values.items()], *[c.alias(n) for n, c in references.items()],
        F.create_map(*[x for n, c in told.items() for x in (F.lit(n), c)]).cast(META).alias("field_meta"), extensions(scope, raw, legacy, unresolved).alias("extensions"), provenance.alias("provenance"),
    )
