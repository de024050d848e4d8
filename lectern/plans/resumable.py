"""Work in batches that survives a crash: a batch's results are written first, its ledger entries last, and only batches with both whole count."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.lineage import cut
from lectern.operators.relations import first_wins
from lectern.plans.snapshots import _fs, checked_run_id


def _whole(spark: SparkSession, root: str, part: str) -> set[str]:
    """Names of the folders under root/part that were written to their end."""
    fs, at = _fs(spark, f"{root}/{part}")
    found = fs.globStatus(at.suffix("/*/_SUCCESS")) if fs.exists(at) else []
    return {str(s.getPath().getParent().getName()) for s in found}


def committed(spark: SparkSession, root: str) -> list[str]:
    """The batches whose results and ledger entries are both there. One without either is as if it had never run."""
    return sorted(_whole(spark, root, "results") & _whole(spark, root, "ledger"))


def _entries(spark: SparkSession, root: str, batches: list[str], key: str, fingerprint: str) -> DataFrame:
    """(key, fingerprint, run, batch): of each key the newest run's entry among the batches."""
    rows = spark.read.parquet(*[f"{root}/ledger/{b}" for b in batches])
    newest = rows.groupBy(key).agg(F.max_by(F.struct(fingerprint, "run", "batch"), F.struct("run", "batch")).alias("_e"))
    return newest.select(key, "_e.*")


def run(spark: SparkSession, inputs: DataFrame, root: str, run_number: int, work: Callable[[DataFrame], DataFrame], key: str, fingerprint: str, batches: int = 8, deal: Column | None = None, order: str | None = None) -> int:
    """Does `work` on the inputs that no committed batch holds under their fingerprint, batch by batch; returns how many inputs it took.

    Inputs are (key, fingerprint, ...), one a key (of several the first by `order`, else by fingerprint); rows without a key or fingerprint are refused by an error. `work` gets a batch's inputs and gives
    rows that hold the key. Of a key only the newest entry counts: where the fingerprint has changed or the batch's results are gone, the key is worked on again.
    A batch that stops half way leaves no entry and is repeated by the next run, which needs a higher number; batches that were done aren't.
    """
    if not inputs.where(F.col(key).isNull() | F.col(fingerprint).isNull()).isEmpty():
        raise ValueError(f"inputs without {key} or {fingerprint}")
    pending = first_wins(inputs, [key], [order or fingerprint])
    done = committed(spark, root)
    if done:
        pending = pending.join(_entries(spark, root, done, key, fingerprint).select(key, fingerprint), [key, fingerprint], "left_anti")
    pending = cut(pending.withColumn("_batch", F.pmod(F.xxhash64(key) if deal is None else deal, F.lit(batches))))
    taken = 0
    for b in range(batches):
        name, part = checked_run_id(f"{run_number:08d}-{b}"), pending.where(F.col("_batch") == b).drop("_batch")
        n = part.count()
        if n:
            work(part).write.mode("overwrite").parquet(f"{root}/results/{name}")
            part.select(key, fingerprint, F.lit(run_number).alias("run"), F.lit(name).alias("batch")).write.mode("overwrite").parquet(f"{root}/ledger/{name}")
            taken += n
    return taken


def results(spark: SparkSession, inputs: DataFrame, root: str, key: str, fingerprint: str) -> DataFrame | None:
    """The results of the inputs' committed entries, None if there is no committed batch. Results of older fingerprints, and of keys that aren't among the inputs, stay out."""
    done = committed(spark, root)
    if not done:
        return None
    entries = _entries(spark, root, done, key, fingerprint).join(inputs.select(key, fingerprint).distinct(), [key, fingerprint], "left_semi").select(key, F.col("batch").alias("_batch"))
    rows = spark.read.option("mergeSchema", True).parquet(*[f"{root}/results/{b}" for b in done]).withColumn("_batch", F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1))
    return rows.join(entries, [key, "_batch"]).drop("_batch")


def forget(spark: SparkSession, root: str, keep: list[str]) -> None:
    """Deletes the batches that aren't in `keep`: leftovers of crashes, and those whose every entry has been replaced."""
    for part in ("ledger", "results"):  # entries first, so that no entry is left without results
        fs, at = _fs(spark, f"{root}/{part}")
        for s in fs.listStatus(at) if fs.exists(at) else []:
            if str(s.getPath().getName()) not in keep:
                fs.delete(s.getPath(), True)
