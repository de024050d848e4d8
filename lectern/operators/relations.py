"""Relational operators: dedupe by key, set and multiset differences, closures, links, versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions.lineage import cut


def first_wins(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in `order` (which must be total to be the same in any run)."""
    return df.withColumn("_row", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_row = 1").drop("_row")


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in `order`. Aggregated before the shuffle, so a hot key costs a row per task."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)


def broken(children: DataFrame, foreign: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose reference has no target."""
    return children.join(parents.select(F.col(key).alias("_key")), F.col(foreign) == F.col("_key"), "left_anti")


def kept(children: DataFrame, foreign: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose reference has a target."""
    return children.join(parents.select(F.col(key).alias("_key")), F.col(foreign) == F.col("_key"), "left_semi")


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows with their surplus in `left` (side left) and in `right` (side right)."""
    names = left.columns
    counted = left.groupBy(*names).agg(F.count("*").alias("n")).unionByName(right.groupBy(*names).agg((-F.count("*")).alias("n")))
    return counted.groupBy(*names).agg(F.sum("n").alias("n")).where("n <> 0").select(*names, F.when(F.col("n") > 0, "left").otherwise("right").alias("side"), F.abs("n").alias("surplus"))


def _ends(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ended, round): (scope, alias, target) of a table of single steps (scope, alias, target), at the end of their chains, and of those that go round a cycle, anywhere on it. Each turn doubles the reach."""
    reach = cut(steps.select("scope", "alias", "target", F.lit(False).alias("ended")))
    for _ in range(steps.count().bit_length() + 1):
        onward = reach.select(F.col("scope").alias("_s"), F.col("alias").alias("_a"), F.col("target").alias("_t"), F.col("ended").alias("_e"))
        open_ = reach.where("not ended")
        if open_.isEmpty():
            break
        met = open_.join(onward, (F.col("scope") == F.col("_s")) & (F.col("target") == F.col("_a")), "left")
        moved = met.select("scope", "alias", F.coalesce("_t", "target").alias("target"), (F.col("_a").isNull() | F.coalesce("_e", F.lit(False))).alias("ended"))
        reach = cut(reach.where("ended").unionByName(moved))
    return reach.where("ended").drop("ended"), reach.where("not ended").drop("ended")


def alias_closure(links: DataFrame, most_scopes: int = 1000) -> DataFrame:
    """(alias, target), or (entity_type, alias, target) if `links` (alias, target) has entity_type: where each alias leads, following links to their end.

    A link of an entity's own type goes before one without a type ("" or null), which holds for every type that occurs, at most `most_scopes`. Of several links of one alias
    the smallest target counts. A chain that runs into a cycle leads to the first alias of the cycle that it meets, so an alias on a cycle leads to itself. Chains may be of any length.
    """
    typed = "entity_type" in links.columns
    scope = F.coalesce(F.col("entity_type"), F.lit("")) if typed else F.lit("")
    one = links.where("alias is not null and target is not null").groupBy(scope.alias("scope"), "alias").agg(F.min("target").alias("target"))
    if typed:
        scopes = [r.scope for r in one.where("scope <> ''").select("scope").distinct().limit(most_scopes + 1).collect()]
        if len(scopes) > most_scopes:
            raise ValueError(f"more than {most_scopes} entity types")
        own = one.where("scope <> ''")
        everywhere = one.where("scope = ''").select(F.explode(F.array(*[F.lit(x) for x in ["", *scopes]])).alias("scope"), "alias", "target")
        one = own.unionByName(everywhere.join(own.select("scope", "alias"), ["scope", "alias"], "left_anti"))
    one = cut(one)
    ended, rounds = _ends(one)
    cycle = cut(rounds.select("scope", F.col("target").alias("alias")).distinct())
    into = one.join(rounds.select("scope", "alias"), ["scope", "alias"], "left_semi").join(cycle, ["scope", "alias"], "left_anti")
    entered, _ = _ends(into)
    out = ended.unionByName(entered).unionByName(cycle.select("scope", "alias", F.col("alias").alias("target")))
    return out.withColumnRenamed("scope", "entity_type") if typed else out.drop("scope")


def version_aliases(before: DataFrame, after: DataFrame, key: Sequence[str], identity: str) -> DataFrame:
    """(key, old_id, new_id): rows of two snapshots with one key and different ids."""
    old = before.select(*key, F.col(identity).alias("old_id"))
    new = after.select(*key, F.col(identity).alias("new_id"))
    return old.join(new, list(key)).where("old_id <> new_id")


def links(*edges: tuple[DataFrame, str, str, str, str, str]) -> DataFrame:
    """(source_type, source_id, relation, target_type, target_id) from (table, type, id, relation, target type, foreign key); empty references give none, repeats stay."""
    parts = [
        df.where(F.col(foreign).isNotNull() & (F.col(foreign).cast("string") != "")).select(
            F.lit(kind).alias("source_type"), F.col(identity).cast("string").alias("source_id"), F.lit(relation).alias("relation"), F.lit(target).alias("target_type"), F.col(foreign).cast("string").alias("target_id")
        )
        for df, kind, identity, relation, target, foreign in edges
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge_objects(objects: DataFrame, key: Sequence[str], values: Sequence[str], order: str, first: bool = False) -> DataFrame:
    """One object per key; of each value the last (or first) that isn't empty."""
    pick = F.min_by if first else F.max_by
    present = lambda c: F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.col(order))
    return objects.groupBy(*key).agg(*[pick(F.col(c), present(c)).alias(c) for c in values])


def united(lists: DataFrame, key: Sequence[str], values: str, order: str) -> DataFrame:
    """(key, values): each key's lists as one, every value once, in the order in which `order` brings them first. Rows are counted once per value before the shuffle."""
    spread = lists.select(*key, order, F.posexplode(values).alias("_at", "_v"))
    once = spread.groupBy(*key, "_v").agg(F.min(F.struct(order, "_at")).alias("_first"))
    return once.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_first", "_v"))), lambda x: x["_v"]).alias(values))


def merge_provenance(records: DataFrame, key: Sequence[str], fields: Sequence[str], order: str, sources: str = "sources") -> DataFrame:
    """(key, fields, sources): of each field the first value that isn't empty, and all source observations (an array), each once, in order."""
    merged = merge_objects(records, key, fields, order, first=True)
    return merged.join(united(records, key, sources, order), list(key), "left").withColumn(sources, F.coalesce(sources, F.array().cast(records.schema[sources].dataType)))


def fallback_join(left: DataFrame, right: DataFrame, key: str, fallback: Sequence[str], value: str) -> DataFrame:
    """`left` with `value` from `right` by `key`, or by the fallback columns where the key finds nothing (of several the least)."""
    direct = right.groupBy(key).agg(F.min(value).alias("_direct"))
    other = right.groupBy(*fallback).agg(F.min(value).alias("_other"))
    return left.join(direct, key, "left").join(other, list(fallback), "left").withColumn(value, F.coalesce("_direct", "_other")).drop("_direct", "_other")


def tree(edges: DataFrame, roots: DataFrame, most_depth: int = 8) -> DataFrame:
    """(node, depth) of the nodes reachable from `roots` (node) along (parent, child) edges within `most_depth` steps, nearest depth, without going round cycles."""
    found = level = cut(roots.select("node", F.lit(0).alias("depth")).distinct())
    for depth in range(1, most_depth + 1):
        level = level.join(edges, F.col("node") == F.col("parent")).select(F.col("child").alias("node")).distinct().join(found.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth))
        level = cut(level)
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return found


def alias_union(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two tables of aliases (legacy_id, canonical_id, ...) as one; of a pair that both have, the later table's row."""
    both = before.withColumn("_later", F.lit(0)).unionByName(after.withColumn("_later", F.lit(1)))
    return last_wins(both, ["legacy_id", "canonical_id"], ["_later"]).drop("_later")
