"""Helpers shared by the operators: cutting lineage, small slices of Arrow batches, hashing of words."""

from __future__ import annotations

import hashlib
import re
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a numpy step works on at once; bounds a Python worker's memory.
SLICE = 1 << 18

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_U = np.uint64


def worker_memory() -> dict:
    """A dictionary that lasts as long as the Python worker, which runs many tasks; the functions themselves come anew with each task."""
    return sys.modules.setdefault("_lectern_worker_memory", types.ModuleType("_lectern_worker_memory")).__dict__


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the one set in the context. Where neither is set: one of our own in local mode, else an error, as executors don't share local folders."""
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


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back: cuts lineage like checkpoint(), in a fraction of the space. forget() deletes it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lectern_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables made by written(), once nothing that is still to run reads them."""
    for df in tables:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._lectern_path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def set_aside(docs: DataFrame, *used: str) -> DataFrame:
    """`docs` as the columns in `used` and one struct of all others, so that no name of theirs can clash with an operator's own."""
    others = [c for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("others"))


def given_back(df: DataFrame, columns: list[str], *used: str) -> list[Column]:
    """The columns of a frame made by set_aside(), under their old names and in their old order."""
    others = [c for c in columns if c not in used]
    return [df[c] if c in used else df["others"][f"c{others.index(c)}"].alias(c) for c in columns]


def small(keys: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A checkpointed table of keys, marked for broadcast if it has at most `most` rows (of 8 bytes or so), else as it is, for a shuffle."""
    return F.broadcast(keys) if keys.count() <= most else keys


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_column(name: str = "text"):
    """The column with nulls as empty strings."""
    return F.coalesce(F.col(name), F.lit(""))


def finite(vector: Column) -> Column:
    """The vector has components, all finite."""
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def usual_size(vectors: DataFrame, vector: str) -> int:
    """The number of components that most rows have (of equally frequent ones the largest); 0 without rows."""
    found = vectors.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return found["size"] if found else 0


def slices(batches: Iterator[pa.RecordBatch], column: int = 0, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose values in the string column take about `most` bytes; a longer text makes a run by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and the offset of each row's first byte (one more at the end), without a copy."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return bytes_, bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of 64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Spans up to this many bytes are hashed all at once, eight bytes a step; longer ones one by one.
_LONG = 64
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], _U)


def eights(data: np.ndarray) -> np.ndarray:
    """For every place (and the end) the eight bytes from there on as one number, zeros beyond the end; a view of a copy of the bytes."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of a byte buffer, equal for equal bytes. Every eight bytes are mixed in one after another; a span over 64 bytes takes its BLAKE2 digest."""
    length = end - start
    out = mix(length.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    who = np.flatnonzero(length <= _LONG)
    if len(who):
        eight, at, left = eights(data), start[who], length[who]
        while len(who):
            out[who] = mix(out[who] ^ (eight[at] & _KEEP[np.minimum(left, 8)]))
            more = left > 8
            who, at, left = who[more], at[more] + 8, left[more] - 8
    long = np.flatnonzero(length > _LONG)
    if len(long):
        raw = data.tobytes()
        out[long] = [int.from_bytes(hashlib.blake2b(raw[a:b], digest_size=8).digest(), "little") for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)]
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def between(*more: int) -> np.ndarray:
    """A table of the bytes that part words: white space, and `more`."""
    out = np.zeros(256, bool)
    out[[*SPACES, *more]] = True
    return out


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes other than white space (or those in `space`) in a row, and the number of words before each row (one more at the end)."""
    space = between() if space is None else space
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~space[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    edges = offsets[:-1][np.diff(offsets) > 0]  # a row's first byte starts a word, the byte before ends one
    first[edges] = inside[1:-1][edges]
    before = edges[edges > 0] - 1
    last[before] = inside[1:-1][before]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)

