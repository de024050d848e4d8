"""Files as DataFrames, always with a stated schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.text import sniff


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One JSON document a file."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType, bad: str = "raise", missing: str = "raise") -> DataFrame:
    """A JSON object a line; blank lines are skipped. bad: "raise" or "skip" lines that are no objects of the schema. missing: "raise", or "empty" for a path that isn't there."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST" if bad == "raise" else "DROPMALFORMED")
    try:
        return reader.json(path)
    except AnalysisException as e:
        if missing == "empty" and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A CSV file with a header, all columns as text; a byte-order mark, quoted line ends and doubled quotes are read, an empty cell is ""."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path).na.fill("")


def typed(df: DataFrame, numbers: Sequence[str] = (), json: dict[str, str] | None = None) -> DataFrame:
    """Text columns as doubles (null where there is no number) and as JSON of the schemas given (an empty array or map where it can't be read)."""
    for c in numbers:
        df = df.withColumn(c, F.col(c).try_cast("double"))
    for c, schema in (json or {}).items():
        empty = F.array() if schema.startswith("array") else F.create_map()
        df = df.withColumn(c, F.coalesce(F.from_json(c, schema), empty.cast(schema)))
    return df


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, kind, sha256) of the files under a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", sniff(F.col("content")).alias("kind"), F.sha2("content", 256).alias("sha256"))


def read_snapshot(spark: SparkSession, path: str, datasets: Sequence[str]) -> dict[str, DataFrame]:
    """The datasets of a snapshot that are there. One that is there and can't be read is an error."""
    found = {}
    for name in datasets:
        try:
            found[name] = spark.read.parquet(f"{path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def write_csv(df: DataFrame, path: str) -> None:
    """A header of sorted names; null as "", nested values as JSON."""
    flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType) else F.col(f.name).cast("string") for f in sorted(df.schema, key=lambda f: f.name)]
    df.select(*flat).na.fill("").write.option("header", True).option("escape", '"').mode("overwrite").csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.option("ignoreNullFields", False).mode("overwrite").json(path)


def replayed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The JSON documents under a path, one a file, with file (its name, by which they are to be taken in order)."""
    return read_json(spark, path, schema).withColumn("file", F.regexp_extract(F.input_file_name(), r"([^/]*)$", 1))


def folder_stats(spark: SparkSession, path: str) -> DataFrame:
    """(n_files, n_bytes) under a path, from the listing alone."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    return listed.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"))
