"""Sharding (operator 6): global prefix sums of byte sizes from per-partition totals, cut at equal targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import cut, text_column


def shard_by_bytes(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """One row per row of `docs`: key, size (UTF-8 bytes of the text, null as none, plus 1), text_crc32, shard (0 to shards - 1), slot (gapless from 0 in a shard).

    Rows lie in the order of key, then checksum and size (nulls first); equal rows are interchangeable. A shard is the
    contiguous run of rows whose middle byte lies in its equal part of the total, so a shard's bytes are off the target by
    less than the largest row. An empty table gives an empty result; other columns are left out.

    Each partition of the range-sorted rows is summed by itself; only the totals (a row per partition) are put in sequence.
    """
    body = text_column(text)
    sized = docs.select(F.col(key).alias("key"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"))
    order = ("key", "text_crc32", "size")
    by = (partitions, *order) if partitions else order
    ranged = cut(sized.repartitionByRange(*by).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition of the data
    whole = Window.partitionBy()
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(whole).alias("total"),
    )
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(F.broadcast(offsets), "part").select(
        *order,
        "total",
        (F.col("rows_before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))).alias("row"),
        (F.col("bytes_before") + F.sum("size").over(within) - F.col("size")).alias("start"),
    )
    placed = placed.select(*order, "row", F.expr(f"cast(least({shards - 1}, ((2 * start + size) * {shards}) div (2 * total)) as int)").alias("shard"))
    placed = cut(placed)
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select(F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("row") - F.col("first")).cast("long").alias("slot"))
