"""Cutting lineage for iterative jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where none is set one of our own in local mode, else an error, as executors don't share local folders."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if at is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(at or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """checkpoint() to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, most: int = 10_000) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back: cuts lineage like checkpoint(), in a fraction of the space.

    Spark would take the files' size for the rows' and broadcast millions of rows that are much alike. So a table of more than `most` rows is marked for a merge in the next join."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    return kept if kept.count() <= most else kept.hint("merge")  # the files' footers tell the count


def small(keys: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A table of keys, checkpointed, and marked for broadcast if it has at most `most` rows; a larger one is for a shuffle."""
    kept = cut(keys)
    return F.broadcast(kept) if kept.count() <= most else kept
