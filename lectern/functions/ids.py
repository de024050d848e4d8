"""Stable identities: hashed ids, source keys with variant and duplicate suffixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from lectern.functions.lineage import small
from lectern.functions.text import stable_text


#: Types whose values can be no address and hold ASCII only.
_NO_TEXT = "^(tinyint|smallint|int|bigint|float|double|decimal.*|boolean|date|timestamp.*)$"


def stable_part(c: Column) -> Column:
    """Web addresses in canonical form, other values normalised; numbers as their text, null as "". Only addresses and texts beyond ASCII go to Python; a column of another type than text has
    neither, and as its type is known when the query is planned, its plan has no Python at all."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(F.typeof(c).rlike(_NO_TEXT), F.lower(text)).otherwise(stable_text(text))


def stable_id(scope: str, kind: str, *parts: Column, prefix: str = "university") -> Column:
    """prefix:scope:kind:24 hex digits of SHA-256 over scope, kind and the parts, joined by "|". An empty prefix is left out."""
    scope, kind = " ".join(scope.split()).casefold(), "_".join(kind.split()).casefold()
    if not scope or not kind:
        raise ValueError("scope and kind must not be empty")
    text = F.concat_ws("|", F.lit(scope), F.lit(kind), *[stable_part(p) for p in parts])
    return F.concat(F.lit(":".join(filter(None, (prefix, scope, kind))) + ":"), F.substr(F.sha2(text, 256), F.lit(1), F.lit(24)))


def legacy_id(scope: str, kind: str, *parts: Column) -> Column:
    """The older form: 20 hex digits of SHA-1 over kind and the parts."""
    text = F.concat_ws("|", F.lit(kind), *[stable_part(p) for p in parts])
    return F.concat(F.lit(f"{scope}:{kind}:"), F.substr(F.sha1(text), F.lit(1), F.lit(20)))


def signature(columns: Sequence[str]) -> Column:
    """A payload's identity: SHA-256 of its columns, in the order of their names, as JSON."""
    return F.sha2(F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(c) for c in sorted(columns)])), 256)


def _shared(df: DataFrame, base: Column, payload: Sequence[str], position: Sequence[str | Column]) -> tuple[DataFrame, DataFrame]:
    """(alone, shared): rows with _base as their key alone, and those of keys that several rows have, with _payload, _same (rows of the same payload) and _row (their number from 1 by `position`).

    Keys are counted before the shuffle; those that repeat are broadcast if they are few. Only rows of repeated keys are signed, shuffled and numbered.
    """
    based = df.withColumn("_base", base)
    often = small(based.groupBy("_base").agg(F.count("*").alias("_n")).where("_n > 1").select("_base"))
    signed = based.join(often, "_base", "left_semi").withColumn("_payload", signature(payload))
    by_payload = Window.partitionBy("_base", "_payload")
    numbered = signed.withColumn("_same", F.count("*").over(by_payload)).withColumn("_row", F.row_number().over(by_payload.orderBy(*position)))
    return based.join(often, "_base", "left_anti"), numbered


def source_keys(df: DataFrame, key: Sequence[str], payload: Sequence[str], position: Sequence[str | Column], strict: bool = False) -> DataFrame:
    """`df` with source_key: the business key's parts that aren't empty, joined by "|".

    Where rows share a key, a payload that occurs once gets "|variant:" with 16 hex digits, and the rows of one that repeats get "|duplicate:" with
    their number from 1 in the order of `position`. Numbers restart for each payload, so two repeating payloads under one key
    get the same keys; `strict` adds the variant before the number and so keeps them apart.
    """
    texts = {f"_key{i}": F.coalesce(c, F.lit("")) for i, c in enumerate(key) if df.schema[c].dataType == StringType()}
    parts = [F.col(f"_key{i}") if f"_key{i}" in texts else F.col(c) for i, c in enumerate(key)]
    alone, shared = _shared(df.withColumns(texts), F.concat_ws("|", *[F.nullif(stable_part(c), F.lit("")) for c in parts]), payload, position)
    variant = F.concat(F.lit("|variant:"), F.substr("_payload", F.lit(1), F.lit(16)))
    repeat = F.concat(F.lit("|duplicate:"), F.col("_row").cast("string"))
    suffix = F.when(F.col("_same") == 1, variant).otherwise(F.concat(variant, repeat) if strict else repeat)
    out = alone.withColumn("source_key", F.col("_base")).unionByName(shared.withColumn("source_key", F.concat("_base", suffix)).drop("_payload", "_same", "_row"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != "source_key"], "source_key")


def variant_ids(df: DataFrame, scope: str, kind: str, key: Sequence[str], payload: Sequence[str], position: Sequence[str | Column], legacy: Sequence[str]) -> DataFrame:
    """`df` with id and legacy_id, both in the older form: id from the key's parts, and where rows share them from "variant" and the payload's signature besides, or, for a payload that repeats, from
    "duplicate" and its rows' number; legacy_id from the `legacy` columns, such as a row's place in its source."""
    parts = [F.col(c) for c in key]
    alone, shared = _shared(df, F.to_json(F.array(*[stable_part(c) for c in parts])), payload, position)
    suffixed = F.when(F.col("_same") == 1, legacy_id(scope, kind, *parts, F.lit("variant"), F.col("_payload"))).otherwise(legacy_id(scope, kind, *parts, F.lit("duplicate"), F.col("_row")))
    out = alone.withColumn("_id", legacy_id(scope, kind, *parts)).unionByName(shared.withColumn("_id", suffixed).drop("_payload", "_same", "_row"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("id", "legacy_id")], F.col("_id").alias("id"), legacy_id(scope, kind, *[F.col(c) for c in legacy]).alias("legacy_id"))


def record_ids(df: DataFrame, scope: str, kind: str, key: Sequence[str], payload: Sequence[str], position: Sequence[str | Column], prefix: str = "university") -> DataFrame:
    """`df` with source_key and record_id, the hashed form of it."""
    return source_keys(df, key, payload, position).withColumn("record_id", stable_id(scope, kind, F.col("source_key"), prefix=prefix))
