"""A snapshot rebuilt from raw records: what is new replaces what was, earlier ids live on as aliases, and a second run changes nothing."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.lineage import cut
from lectern.operators.relations import alias_union, multiset_difference, version_aliases
from lectern.plans.snapshots import ALIAS, active, datasets_of, publish

ALIASES, RAW = "aliases", "raw"


def _same(before: DataFrame, after: DataFrame) -> bool:
    """Whether two tables hold the same rows under the same columns."""
    if sorted(before.dtypes) != sorted(after.dtypes):
        return False
    return multiset_difference(before.select(*after.columns), after).isEmpty()


def moved_ids(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], keys: Mapping[str, str], identity: str = "id") -> DataFrame | None:
    """(entity_type, legacy_id, canonical_id): rows of a dataset that both sides have, with one source key and another id; None where no dataset is on both sides."""
    out = None
    for name, key in keys.items():
        if name in before and name in after:
            own = version_aliases(before[name], after[name], [key], identity)
            one = own.select(F.lit(name).alias("entity_type"), F.col("old_id").cast("string").alias("legacy_id"), F.col("new_id").cast("string").alias("canonical_id")).distinct()
            out = one if out is None else out.unionByName(one)
    return out


def migrate(
    spark: SparkSession, root: str, run_id: str, records: DataFrame, rebuild: Callable[[DataFrame], dict[str, DataFrame]], keys: Mapping[str, str], explicit: DataFrame | None = None, identity: str = "id", required: tuple[str, ...] = ()
) -> dict:
    """Rebuilds the datasets from replayed raw records and publishes them at root with the aliases and the raw records; returns the report, with `changed` and the number of aliases.

    A three-way merge: datasets come from the records alone; aliases are those of the current snapshot, those of rows whose source key (`keys`: dataset to column) stayed and whose id didn't,
    and the `explicit` ones (entity_type, legacy_id, canonical_id), the later of equal pairs counting; an alias of an id to itself is left out. If datasets, aliases and raw records are all as in
    the current snapshot, nothing is published and changed is false, so a second run is free of effect. A rebuild that the gate refuses leaves the current snapshot in place.
    """
    records = cut(records)
    rebuilt = {name: cut(df) for name, df in rebuild(records).items()}
    at = active(spark, root)
    held = {name: spark.read.parquet(f"{at}/{name}") for name in datasets_of(spark, at)} if at else {}
    aliases = held.get(ALIASES, spark.createDataFrame([], ALIAS))
    for more in (moved_ids(held, rebuilt, keys, identity), explicit):
        if more is not None:
            aliases = alias_union(aliases, more.select("entity_type", "legacy_id", "canonical_id"))
    aliases = cut(aliases.where("legacy_id <> '' and canonical_id <> '' and legacy_id <> canonical_id"))
    after = rebuilt | {ALIASES: aliases, RAW: records}
    report = {"replayed": True, "aliases": aliases.count(), "changed": set(held) != set(after) or not all(_same(held[n], df) for n, df in after.items())}
    if not report["changed"]:
        return report | {"passed": True, "snapshot": at}
    done = publish(spark, root, run_id, after, required, {name: identity for name in rebuilt} | {ALIASES: None, RAW: None})
    return report | done | {"snapshot": active(spark, root)}
