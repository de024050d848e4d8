"""Projections: presence metadata, references, extensions, nested arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.ids import stable_id
from lectern.functions.text import is_present


def published_meta(c: Column) -> Column:
    """struct(status, method, confidence) of a field: published if present (0 and false are), else not_published."""
    there = is_present(c)
    return F.struct(F.when(there, "published").otherwise("not_published").alias("status"), F.lit("source").alias("method"), F.when(there, 1.0).otherwise(0.0).alias("confidence"))


def field_meta(**columns: Column) -> Column:
    """A map from field to its presence."""
    return F.create_map(*[x for name, c in columns.items() for x in (F.lit(name), published_meta(c))])


def relation_id(key: Column, scope: str, kind: str, enabled: bool, prefix: str = "university") -> tuple[Column, Column]:
    """(id, unresolved): "" for an empty key, or with the key as unresolved where the target isn't enabled, else the hashed id, as the target's own row has it."""
    empty, text = ~is_present(key), key.cast("string")
    if not enabled:
        return F.lit(""), F.when(~empty, text)
    return F.when(empty, "").otherwise(stable_id(scope, kind, key, prefix=prefix)), F.lit(None).cast("string")


def extensions(scope: str, raw: Column, legacy: Column, unresolved: Column) -> Column:
    """A map scope -> values (map of text) with legacy ids and unresolved references under their own names; empty if there is nothing."""
    all_values = F.map_concat(raw, F.create_map(F.lit("legacy_ids"), F.to_json(legacy), F.lit("unresolved_references"), F.to_json(unresolved)))
    kept = F.map_filter(all_values, lambda k, v: v.isNotNull() & ~v.isin("", "{}", "[]"))
    return F.when(F.size(kept) > 0, F.create_map(F.lit(scope), kept)).otherwise(F.create_map().cast("map<string,map<string,string>>"))


def array_or(first: Column, second: Column) -> Column:
    """The first array, the second where it is null or empty."""
    return F.when(F.coalesce(F.size(first), F.lit(0)) > 0, first).otherwise(second)


def lines(c: Column) -> Column:
    """A text's lines without blanks and semicolons at their ends, empty ones left out."""
    return F.filter(F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, "^[ ;]+|[ ;]+$", "")), lambda x: x != "")


def rows_of(df: DataFrame, array: str, keep: list[str], ordinal: str = "ordinal") -> DataFrame:
    """A row for each element of an array of structs, with its place from 0."""
    return df.select(*keep, F.posexplode(array).alias(ordinal, "_e")).select(*keep, ordinal, "_e.*")


def loads_or_self(loads: Column, own: Column) -> Column:
    """Nested loads, or the row itself as its only load."""
    return array_or(loads, F.array(own))


def gather(df: DataFrame, key: list[str], order: list[str], value: Column, alias: str) -> DataFrame:
    """(key, alias): the rows of a key as an array in order. For keys of bounded size (the lines of an order, the cells of a row)."""
    collected = F.array_sort(F.collect_list(F.struct(*order, value.alias("_v"))))
    return df.groupBy(*key).agg(F.transform(collected, lambda x: x["_v"]).alias(alias))
