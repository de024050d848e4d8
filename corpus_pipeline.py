"""The corpus pipeline: quality classifier, near duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import cut, given_back, set_aside, small, table, written
from lectern.llm.importance import classify
from lectern.llm.jaccard import jaccard_components
from lectern.llm.packing import pack
from lectern.llm.queries import pattern, vocabulary
from lectern.llm.repeats import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    kept = classify(set_aside(docs, "doc_id", "text"), table(spark, sf_dir, "labels")).where("keep")
    return kept.select(*given_back(kept, docs.columns, "doc_id", "text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component (five-word shingles, similarity 0.8 or more): the one with the smallest id, null ids last; of rows that repeat an id in a component one. Texts without a word all stay.

    Rows are told apart by a number of their own, not by doc_id, so repeated rows and rows without an id are members like all others.
    """
    rows = written(set_aside(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id()))
    found = cut(jaccard_components(rows, n=5, num=4, den=5, key="row").where("n_shingles > 0").select("row", "component_id"))
    own = found.join(rows.select("row", "doc_id"), "row")
    best = own.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best"), F.count("*").alias("n"))
    best = small(cut(best.where("n > 1").select("component_id", F.col("best.row").alias("stays"))))
    gone = small(cut(found.join(best, "component_id").where("row <> stays").select("row")))
    left = rows.join(gone, "row", "left_anti")
    return left.select(*given_back(left, docs.columns, "doc_id", "text"))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes or more that occur again anywhere; whole characters only."""
    done = remove_repeats(set_aside(docs, "n_chars", "text"), 200, whole_characters=True)
    done = done.withColumn("text", F.decode("kept", "UTF-8")).withColumn("n_chars", F.length("text").cast("long"))
    return done.select(*given_back(done, docs.columns, "n_chars", "text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), pattern())


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", passages), ("harmonic packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
