"""Centroid clustering (operator 12): Lloyd's rounds over integer vectors, each vector's centroid found by partial distances."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import finite, written

#: Scaled components must lie within this.
MOST = 1 << 62


def nearest(x: np.ndarray, centroids: np.ndarray, step: int = 8, report: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each row's nearest centroid, ties to the smaller number. Columns come in falling order of variance.

    Squared differences are added up `step` columns at a time. A row's bound is the whole distance of the centroid that leads after the first columns; a pair is given up once its sum is
    strictly above the bound, so equal distances live on. Pairs left at the end have all columns.
    """
    part = np.zeros((len(x), len(centroids)), np.int64)
    for d in range(min(step, x.shape[1])):
        part += (x[:, d, None] - centroids[None, :, d]) ** 2
    bound = ((x - centroids[part.argmin(1)]) ** 2).sum(1)
    row, centroid = np.nonzero(part <= bound[:, None])
    total, added = part[row, centroid], part.size * min(step, x.shape[1])
    for d in range(step, x.shape[1], step):
        total += ((x[row, d : d + step] - centroids[centroid, d : d + step]) ** 2).sum(1)
        added += len(row) * min(step, x.shape[1] - d)
        left = total <= bound[row]
        row, centroid, total = row[left], centroid[left], total[left]
    least = np.minimum.reduceat(total, np.searchsorted(row, np.arange(len(x)))) if len(x) else total
    first = np.flatnonzero(total == least[row])
    _, at = np.unique(row[first], return_index=True)  # the smallest number of equally near ones
    if report is not None:
        report["differences"] = report.get("differences", 0) + added
        report["of"] = report.get("of", 0) + x.size * len(centroids)
    return centroid[first[at]], least


def _assigned(centroids: np.ndarray, order: np.ndarray, rows: int = 1 << 21) -> Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """A function that gives (first row, vectors, centroids, distances) for blocks of a batch with ids and vectors; blocks shrink as centroids grow in number."""
    dims, block = centroids.shape[1], max(1, rows // max(centroids.size, 1) * 16)
    ordered = np.ascontiguousarray(centroids[:, order])

    def assign(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        x = batch.column(1).flatten().to_numpy().reshape(-1, dims)
        for a in range(0, len(x), block):
            part = x[a : a + block]
            yield (a, part, *nearest(np.ascontiguousarray(part[:, order]), ordered))

    return assign


def spreads(dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: each task's count, least and largest value, sum and sum of squares of every component."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, total, squares = 0, np.full(dims, np.iinfo(np.int64).max), np.full(dims, np.iinfo(np.int64).min), np.zeros(dims), np.zeros(dims)
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, dims)
            if len(x):
                n, low, high = n + len(x), np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
                total, squares = total + x.sum(0, dtype=np.float64), squares + np.square(x.astype(np.float64)).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.arange(dims, dtype=np.int32), np.full(dims, n), low, high, total, squares)], ["d", "n", "low", "high", "sum", "squares"])

    return add_up


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, key: str = "vec_id", vector: str = "embedding", scale: int = 256, dims: int = 64) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), a row for each vector of exactly `dims` components, none null or non-finite.

    Components x become floor(scale * x) as doubles. The k kept vectors with the smallest SHA-256 of `<seed>:<id>` are the first centroids (of repeated ids the smaller vector first, null ids
    last; all vectors, if fewer). Each round assigns every vector and replaces each centroid that has vectors by floor(sum / count) of each component, empty ones stay; one more assignment follows.
    Sums and distances are exact integers. Vectors too far apart for squared distances in 64 bits raise OverflowError; an inertia beyond 64 bits is Spark's arithmetic error.
    Repeated rows are vectors of their own. An empty table, or one without a vector to keep, gives an empty result. Other columns are left out.

    Every round is one pass over a table of integers: each task sends k counts and sums, and the driver holds k centroids; nothing else leaves a task.
    """
    spark = vectors.sparkSession
    kept = vectors.where((F.size(vector) == dims) & finite(F.col(vector)))
    ints = written(kept.select(F.col(key).cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v")))
    spread = ints.select("vec_id", "v").mapInArrow(spreads(dims), "d int, n long, low long, high long, sum double, squares double")
    found = sorted(spread.groupBy("d").agg(F.sum("n"), F.min("low"), F.max("high"), F.sum("sum"), F.sum("squares")).collect())
    if not found:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    _, n, low, high, total, squares = zip(*found, strict=True)
    if max(map(abs, low + high)) > MOST or sum((b - a) ** 2 for a, b in zip(low, high, strict=True)) >= 1 << 63:
        raise OverflowError(f"{vector}: squared distances beyond 64 bits after scaling")
    variance = np.array(squares) / n - (np.array(total) / n) ** 2
    order, least = np.argsort(-variance, kind="stable"), np.array(low, np.int64)
    first = ints.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "v").limit(k)
    centroids = np.array([r["v"] for r in first.collect()], np.int64)

    for _ in range(rounds):
        assign = _assigned(centroids, order)

        def add_up(batches: Iterator[pa.RecordBatch], assign=assign, n=len(centroids)) -> Iterator[pa.RecordBatch]:
            """Counts and sums of this task; sums of differences from the least value, so that blocks add up exactly as doubles."""
            counts, sums = np.zeros(n, np.int64), np.zeros((n, dims), np.int64)
            for batch in batches:
                for _, part, cluster, _ in assign(batch):
                    counts += np.bincount(cluster, minlength=n)
                    sums += ((np.arange(n)[:, None] == cluster).astype(np.float64) @ (part - least).astype(np.float64)).astype(np.int64)
            there = np.flatnonzero(counts)
            columns = np.repeat(there, dims).astype(np.int32), np.tile(np.arange(dims, dtype=np.int32), len(there)), np.repeat(counts[there], dims), sums[there].reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "d", "n", "sum"])

        parts = ints.mapInArrow(add_up, "cluster int, d int, n long, sum long").groupBy("cluster", "d").agg(F.sum("n"), F.sum(F.col("sum").cast("decimal(38,0)")))
        for cluster, d, n, total in parts.collect():
            centroids[cluster, d] = low[d] + int(total) // n

    assign = _assigned(centroids, order)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, part, cluster, distance in assign(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(part)), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    done = written(ints.mapInArrow(settle, "vec_id long, cluster int, distance long"))
    totals = dict(done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    rows = [(c, int(total), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, total in totals.items()]
    about = F.broadcast(spark.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string"))  # k rows at most
    return done.join(about, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(map(int, totals.values()))).cast("long").alias("inertia"), "centroid_sha256")
