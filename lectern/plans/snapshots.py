"""Versioned snapshots with a pointer, run manifests and checkpoint ledgers. Paths go through Hadoop's file system, so they may be in any store that Spark reads."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import stripped
from lectern.operators.integrity import dataset_counts, gate
from lectern.sources.files import write_jsonl


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside and then renamed over its place in one step, so that readers see the old or the new one."""
    fs, p = _fs(spark, path)
    p = fs.makeQualified(p)
    temporary = p.suffix(".part")
    out = fs.create(temporary, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf).rename(temporary, p, rename)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def checked_run_id(run_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}", run_id) or ".." in run_id:
        raise ValueError(f"not a run id: {run_id!r}")
    return run_id


def publish(spark: SparkSession, root: str, run_id: str, datasets: dict[str, DataFrame], required: tuple[str, ...] = (), keys: Mapping[str, str | None] | None = None, checks: DataFrame | None = None, available: Collection[str] | None = None) -> dict:
    """Writes the datasets (those in `available`, if given) to root/staging/run_id, runs the gate on what was written and, only if it passes, moves the snapshot to root/snapshots/run_id and points
    root/current at it. A snapshot that fails leaves the pointer as it was. Returns the report. keys: the column of
    each dataset's ids, "id" where none is given, None for a dataset without ids, which the gate doesn't count."""
    staging, final = f"{root}/staging/{checked_run_id(run_id)}", f"{root}/snapshots/{run_id}"
    datasets = {name: df for name, df in datasets.items() if available is None or name in available}
    for name, df in datasets.items():
        df.write.mode("overwrite").parquet(f"{staging}/{name}")
    written = {name: spark.read.parquet(f"{staging}/{name}") for name in datasets}
    named = {name: (keys or {}).get(name, "id") for name in written}
    counted = dataset_counts({name: (written[name], key) for name, key in named.items() if key is not None})
    report = gate(counted, checks if checks is not None else spark.createDataFrame([], "name string, passed boolean"), required)
    fs, at = _fs(spark, staging)
    if not report["passed"]:
        fs.delete(at, True)
        return report
    _, to = _fs(spark, final)
    if fs.exists(to):
        raise ValueError(f"run {run_id} is published already")
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"cannot publish {run_id}")
    try:
        write_text(spark, f"{final}/manifest.json", json.dumps({"run_id": run_id, **report}, sort_keys=True))
        write_text(spark, f"{root}/current", run_id)
    except Exception:
        fs.delete(to, True)  # the pointer is as it was
        raise
    return report


def active(spark: SparkSession, root: str) -> str | None:
    """The path of the current snapshot, None before the first or if the snapshot that the pointer names is gone."""
    run_id = (read_text(spark, f"{root}/current") or "").strip()
    if not run_id:
        return None
    fs, p = _fs(spark, f"{root}/snapshots/{checked_run_id(run_id)}")
    return f"{root}/snapshots/{run_id}" if fs.exists(p) else None


def datasets_of(spark: SparkSession, snapshot: str) -> list[str]:
    """The names of a snapshot's datasets: its folders that were written to their end."""
    fs, at = _fs(spark, snapshot)
    return sorted(str(s.getPath().getParent().getName()) for s in fs.globStatus(at.suffix("/*/_SUCCESS")))


def open_views(spark: SparkSession, root: str, prefix: str = "") -> dict[str, str]:
    """Points this session's views <prefix><dataset> at the current snapshot and returns the snapshot's path by view name; empty before the first publication.

    The pointer is read once, so all views show one snapshot, whatever is published meanwhile; a snapshot's files never change, so queries under way go on as they began. Views of datasets that
    the snapshot no longer has are dropped, where a prefix tells them from others. A session moves on to a later snapshot when it calls this again.
    """
    at = active(spark, root)
    names = datasets_of(spark, at) if at else []
    for old in spark.catalog.listTables():
        if old.isTemporary and old.name.startswith(prefix.lower()) and prefix and old.name not in {f"{prefix}{n}".lower() for n in names}:
            spark.catalog.dropTempView(old.name)
    for name in names:
        spark.read.parquet(f"{at}/{name}").createOrReplaceTempView(f"{prefix}{name}")
    return {f"{prefix}{name}": at for name in names}


def config_hash(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def resume(inputs: DataFrame, ledger: DataFrame | None, key: str, fingerprint: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`work` on the inputs whose (key, fingerprint) the ledger doesn't hold."""
    if ledger is not None:
        inputs = inputs.join(ledger.select(key, fingerprint).distinct(), [key, fingerprint], "left_anti")
    return work(inputs)


def ledger_of(done: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Ledger rows for finished inputs; of a key's fingerprints the newest run's is what counts."""
    return done.select(key, fingerprint).distinct().withColumn("marked_at", F.current_timestamp())


ALIAS = "entity_type string, legacy_id string, canonical_id string"


def write_aliases(aliases: DataFrame, snapshot: str) -> None:
    """Aliases (entity_type, legacy_id, canonical_id) as lines of JSON in the folder id_aliases of a snapshot, written by the tasks that hold them."""
    write_jsonl(aliases.select("entity_type", "legacy_id", "canonical_id"), f"{snapshot}/id_aliases")


def read_aliases(spark: SparkSession, snapshot: str) -> DataFrame:
    """(entity_type, legacy_id, canonical_id) of a snapshot's folder id_aliases, or of a file id_aliases.json with all in one array, without blank ids; empty where neither is there. What can't be read is left out.
    The folder is read in parallel; a single file is read by one task, and never by the driver."""
    fs, folder = _fs(spark, f"{snapshot}/id_aliases")
    if fs.exists(folder):
        rows = spark.read.schema(ALIAS).json(f"{snapshot}/id_aliases")
    elif fs.exists(_fs(spark, f"{snapshot}/id_aliases.json")[1]):
        whole = spark.read.schema(f"aliases array<struct<{ALIAS}>>".replace(" string", ":string")).option("multiLine", True).json(f"{snapshot}/id_aliases.json")
        rows = whole.select(F.explode("aliases").alias("a")).select("a.*")
    else:
        rows = spark.createDataFrame([], ALIAS)
    return rows.select(stripped(F.coalesce("entity_type", F.lit(""))).alias("entity_type"), "legacy_id", "canonical_id").where("legacy_id <> '' and canonical_id <> ''")


def unexpired(entries: DataFrame, at: str, seconds: int, now: Column | None = None) -> DataFrame:
    """Entries that aren't older than `seconds` before `now` (the time of the query). Entries without a time are kept, as nothing says that they are old."""
    cutoff = (F.current_timestamp() if now is None else now) - F.make_dt_interval(secs=F.lit(seconds))
    return entries.where(F.col(at).isNull() | (F.col(at) >= cutoff))


def mark(done: DataFrame, path: str, key: str, fingerprint: str, run: int) -> None:
    """Appends finished inputs to the ledger at `path`."""
    done.select(key, fingerprint).distinct().withColumn("run", F.lit(run)).write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Of each key the entry of its newest run."""
    entries = spark.read.parquet(path)
    rest = [c for c in entries.columns if c != key]
    best = entries.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("run", *[c for c in rest if c != "run"])).alias("_e"))
    return best.select(key, "_e.*")
