"""Checks on what a source delivers, before it is normalised."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import is_present, stripped

LOCATORS = ("source_page", "list_api", "detail_api", "detail_page")


#: An address of the web with a host, or of a file with a place.
ADDRESS = r"(?i)^(https?://[^/?#\s]+|file:(//)?[^\s/]|file:/+[^\s/])"


def has_locator(observations: Column) -> Column:
    """Any of the source observations (an array of structs with the LOCATORS) names an address where the record can be looked up. Never null."""
    named = lambda o: reduce(or_, [F.coalesce(stripped(o[c]).rlike(ADDRESS), F.lit(False)) for c in LOCATORS])
    return F.coalesce(F.exists(observations, named), F.lit(False))


def has_lineage(observations: Column) -> Column:
    """Any of the source observations names a raw snapshot. Never null."""
    return F.coalesce(F.exists(observations, lambda o: is_present(o["raw_snapshot_path"])), F.lit(False))


def violations(records: DataFrame, persists_raw: bool = False) -> DataFrame:
    """(source_key, rule) of records (source_key, provenance struct with the locators, source_key and raw_snapshot_path, legacy_ids array) that break the contract of sources: a key that isn't
    empty nor repeated (named once), provenance of the same key that names an address, with a raw snapshot where the source keeps these, and legacy ids without blanks."""
    key = stripped(F.coalesce("source_key", F.lit("")))
    p = F.col("provenance")
    address = F.lit(False)
    for c in LOCATORS:
        address = address | F.coalesce(stripped(p[c]).rlike(ADDRESS), F.lit(False))
    rules = F.array_compact(
        F.array(
            F.when(key == "", "empty_source_key"),
            F.when(p.isNull(), "no_provenance"),
            F.when(p.isNotNull() & (stripped(F.coalesce(p["source_key"], F.lit(""))) != key), "provenance_of_another_key"),
            F.when(p.isNotNull() & ~address, "no_locator"),
            F.when(p.isNotNull() & F.lit(persists_raw) & ~is_present(p["raw_snapshot_path"]), "no_lineage"),
            F.when(F.exists(F.coalesce("legacy_ids", F.array().cast("array<string>")), lambda x: ~F.coalesce(is_present(stripped(x)), F.lit(False))), "blank_legacy_id"),
        )
    )
    each = records.select("source_key", F.explode(rules).alias("rule"))
    repeated = records.where(key != "").groupBy("source_key").count().where("count > 1").select("source_key", F.lit("duplicate_source_key").alias("rule"))
    return each.unionByName(repeated)


def check(records: DataFrame, complete: bool = True, warnings: tuple[str, ...] = (), gaps: tuple[str, ...] = (), persists_raw: bool = False, most: int = 20) -> DataFrame:
    """The records, if they keep the contract; else an error that names some that don't. A delivery that isn't complete must say why."""
    if not complete and not (warnings or gaps):
        raise ValueError("a partial delivery must come with warnings or gaps")
    if any(not w.strip() for w in (*warnings, *gaps)):
        raise ValueError("warnings and gaps must not be blank")
    found = violations(records, persists_raw).orderBy("source_key", "rule").limit(most).collect()
    if found:
        raise ValueError("; ".join(f"{r.source_key!r}: {r.rule}" for r in found))
    return records
