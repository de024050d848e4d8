"""Exact top-k search (operator 4): vector-approximation files over integer vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import cut, finite, small, usual_size, written

#: Components must lie within this, so that bounds stay within 64 bits.
MOST = 1 << 61


def approximate(data: np.ndarray, low: np.ndarray, width: np.ndarray, bits: int) -> np.ndarray:
    """A row of packed cells for each vector, `bits` a dimension: which part of its dimension's range a component lies in."""
    cells = ((data - low) // width).astype(np.uint8)
    return np.packbits(np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - bits :].reshape(len(data), -1), axis=1)


def middles(packed: np.ndarray, low: np.ndarray, width: np.ndarray, bits: int) -> np.ndarray:
    """The middle of each vector's cells."""
    n, dims = len(packed), len(low)
    flags = np.zeros((n, dims, 8), np.uint8)
    flags[:, :, 8 - bits :] = np.unpackbits(packed, axis=1)[:, : dims * bits].reshape(n, dims, bits)
    return low + np.packbits(flags, axis=2)[:, :, 0].astype(np.float64) * width + (width - 1) / 2


def slacks(queries: np.ndarray, low: np.ndarray, width: np.ndarray, bits: int) -> np.ndarray:
    """For each query the most that a product with the middle of a cell can be off: half of each width, and the rounding of sums of doubles."""
    size = np.abs(queries).astype(np.float64)
    reach = size @ (np.maximum(np.abs(low), np.abs(low + (width << bits))) + width).astype(np.float64)
    return size @ ((width - 1) / 2) + np.where(reach < 2.0**51, 0, reach * (len(low) + 8) * 2.0**-51)


def bounded(middle: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, slack: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, places, products of the cells' middles) of the vectors that bounds leave: those whose upper bound is not below the kth largest lower bound. A query's own id is no candidate."""
    for a in range(0, len(queries), 16):
        about = middle @ queries[a : a + 16].T.astype(np.float64)
        for q in range(a, min(a + 16, len(queries))):
            other = np.flatnonzero(ids != query_ids[q])
            keep = min(k, len(other))
            if keep:
                own = about[other, q - a]
                left = own >= np.partition(own, len(own) - keep)[len(own) - keep] - 2 * slack[q]
                yield q, other[left], own[left]


def top_products(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256, bits: int = 6, group_rows: int = 32_768, block_rows: int = 4096, query_rows: int = 256, report: dict | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest integer inner products among all other rows; ties to the smaller id.

    Components x become floor(scale * x) as doubles. Rows that are null, hold null or non-finite components, or have a null id take no part;
    of the others those whose length differs from the most frequent one take no part either. Components beyond 2**61 raise OverflowError, scores beyond 64 bits Spark's arithmetic error.
    Repeated ids keep all their rows as candidates and are one query (the smallest vector); a row with the query's own id is never its candidate. An empty table gives an empty result.

    The approximation file has `bits` a component. It is dealt to groups of about `group_rows` vectors, which stay in their task while the blocks of queries come by; each vector gets an upper and
    a lower bound from its cells alone. Of those left, exact vectors are read in rounds in the order of their bounds, four times more each round, until no bound reaches the kth score.
    `report`, if given, gets the numbers of bounds, of vectors that bounds left and of exact reads.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    good = vectors.where(F.col(key).isNotNull() & finite(F.col(vector)))
    dims = usual_size(good, vector)
    if dims <= 0:
        return empty
    ints = good.where(F.size(vector) == dims).select(F.col(key).cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"), is_query.alias("q"))
    ints = written(ints.withColumn("row", F.monotonically_increasing_id()))
    bounds = ints.agg(F.count("*"), F.sum(F.col("q").cast("long")), *[f(F.get("v", F.lit(d))) for f in (F.min, F.max) for d in range(dims)]).first()
    n, n_queries = bounds[0], bounds[1] or 0
    if not n_queries:
        return empty
    if max(map(abs, bounds[2:])) > MOST:
        raise OverflowError(f"{vector}: components beyond 2**61 after scaling")
    low, high = np.array(bounds[2 : 2 + dims], np.int64), np.array(bounds[2 + dims :], np.int64)
    width = ((high - low) >> bits) + 1
    groups, query_blocks = -(-n // group_rows), -(-n_queries // query_rows)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of the approximation file."""
        held: dict[int, list] = {}
        for batch in batches:
            at, rows, ids = (batch.column(i).to_numpy() for i in range(3))
            cells = approximate(batch.column(3).flatten().to_numpy().reshape(-1, dims), low, width, bits) if len(at) else None
            for g in np.unique(at):
                held.setdefault(int(g), []).append((rows[at == g], ids[at == g], cells[at == g]))
                if sum(len(x[0]) for x in held[int(g)]) >= block_rows:
                    yield block(int(g), held.pop(int(g)))
        for g, parts in held.items():
            yield block(g, parts)

    def block(g: int, parts: list) -> pa.RecordBatch:
        data = [np.concatenate(x) for x in zip(*parts, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([0], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in data)], ["group", "turn", "rows", "ids", "data"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of queries."""
        for batch in batches:
            for a in range(0, batch.num_rows, query_rows):
                part = batch.slice(a, query_rows)
                data = part.column(0).to_numpy(), part.column(1).flatten().to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in data], ["ids", "data"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, middle, rows, ids = None, [], None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                group, turn = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if group != now:
                    now, held, middle = group, [], None
                if turn == 0:
                    held.append(tuple(batch.column(c)[i].as_py() for c in (2, 3, 4)))
                    continue
                if middle is None:
                    rows, ids = (np.frombuffer(b"".join(x[c] for x in held), "<i8") for c in (0, 1))
                    middle = middles(np.frombuffer(b"".join(x[2] for x in held), np.uint8).reshape(len(rows), -1), low, width, bits)
                query_ids = np.frombuffer(batch.column(3)[i].as_py(), "<i8")
                queries = np.frombuffer(batch.column(4)[i].as_py(), "<i8").reshape(-1, dims)
                slack = slacks(queries, low, width, bits)
                found = [(np.full(len(at), query_ids[q]), rows[at], ids[at], about + slack[q], about - slack[q]) for q, at, about in bounded(middle, ids, query_ids, queries, slack, k)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["query_id", "row", "vec_id", "upper", "lower"])

    queries = ints.where("q").groupBy("vec_id").agg(F.min("v").alias("v"))
    file = ints.select(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"), "row", "vec_id", "v").mapInArrow(packed, "group int, turn int, rows binary, ids binary, data binary")
    turns = queries.repartition(query_blocks, "vec_id").mapInArrow(asked, "ids binary, data binary").select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("turn"), F.lit(b"").alias("rows"), "ids", "data")
    met = file.unionByName(turns).repartition(groups, "group").sortWithinPartitions("group", "turn")  # a stated query set against all rows, in blocks
    left = written(met.mapInArrow(scan, "query_id long, row long, vec_id long, upper double, lower double"))
    kth_lower = left.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("lower")))).where(F.col("n") == k).select("query_id", F.col("lower").alias("edge"))
    left = left.join(kth_lower, "query_id", "left").where("edge is null or upper >= edge")
    left = written(left.select("query_id", "row", "vec_id", "upper", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("upper"), "row")).alias("n")))
    if report is not None:
        report |= {"bounds": n * n_queries, "left": left.count(), "exact": 0}
    best, at, step = None, 0, 4 * k
    while not left.isEmpty():
        part = left.where(F.col("n") <= at + step)
        if report is not None:
            report["exact"] += part.count()
        rows = ints.join(small(cut(part.select("row").distinct())), "row", "left_semi").select("row", "v")
        met = part.join(rows, "row").join(queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("w")), "query_id")
        scored = met.select("query_id", "vec_id", F.aggregate(F.zip_with("v", "w", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x).alias("score"))
        ranks = (scored if best is None else scored.unionByName(best.drop("rank"))).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        best = cut(ranks.where(F.col("rank") <= k))
        kth = best.where(F.col("rank") == k).select("query_id", "score")
        at, step = at + step, 4 * step
        left = cut(left.where(F.col("n") > at).join(kth, "query_id", "left").where("score is null or upper >= score").drop("score"))
    return empty if best is None else best.select("query_id", "rank", "vec_id", "score")
