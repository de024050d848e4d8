"""Connected components of a table of links: each partition contracts its own links to stars, then rounds of large-star and small-star contraction join the partitions' stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import cut


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links (u, v) of one partition as links from each node to the smallest of its component there."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 1 << 16):
        part = nodes[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["u", "v"])


def components(links: DataFrame, most_rounds: int = 64, partition_rows: int = 100_000) -> DataFrame:
    """(node, component): for every node of `links` (a, b; 64-bit ids) that has a link the smallest node reachable.

    Links are dealt to partitions of about `partition_rows`, which bounds a task's memory. Where there is more than one, each round is an aggregate on the node, which
    adds up before the shuffle, and a join, in which a hub's links are rows of one key that adaptive execution splits.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    parts = 1 + edges.count() // partition_rows
    edges = cut(edges.coalesce(parts).mapInArrow(stars, "u long, v long"))
    before = None
    for _ in range(most_rounds if parts > 1 else 0):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(hooked.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if now == before:
            break
        before = now
    else:
        if parts > 1:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
