"""Incremental ingestion: new files only, first record of a key wins, late rows dropped by a watermark."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_rows(spark: SparkSession, path: str, schema, kind: str = "parquet") -> DataFrame:
    """A folder's files as a stream."""
    return spark.readStream.schema(schema).format(kind).load(path)


def first_per_key(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row of each key; state is kept for `delay` of event time."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def windowed_counts(stream: DataFrame, time: str, width: str, delay: str, *key: str) -> DataFrame:
    """Rows and sums by window; works on a batch, too."""
    if stream.isStreaming:
        stream = stream.withWatermark(time, delay)
    grouped = stream.groupBy(F.window(time, width).alias("w"), *key).agg(F.count("*").alias("n"))
    return grouped.select(F.col("w.start").alias("window_start"), *key, "n")


def run_once(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """All that is new, in batches, and then an end. `batch` must give the same result if a batch comes again. mode complete gives the whole result of an aggregation each time."""
    return stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).foreachBatch(batch).start()


def keep_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A `batch` that writes each batch to a folder of its own under `path`, so one that comes again takes its own place."""
    return lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}")


def keep_latest(path: str) -> Callable[[DataFrame, int], None]:
    """A `batch` for complete results: each takes the place of the one before."""
    return lambda df, n: df.write.mode("overwrite").parquet(path)
