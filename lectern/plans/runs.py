"""The record of a run: what each stage read and wrote, counted while it was written."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lectern.plans.snapshots import _fs, checked_run_id, read_text, write_text

STAGES = (
    "stages array<struct<name:string,status:string,completed_at:string,rows:bigint,metrics:map<string,string>,"
    "inputs:array<struct<ref:string,kind:string,available:boolean,file_count:bigint,size_bytes:bigint,sha256:string>>,outputs:array<struct<ref:string,kind:string,available:boolean,file_count:bigint,size_bytes:bigint,sha256:string>>>>"
)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def reference(spark: SparkSession, root: str, ref: str) -> dict:
    """What a name stands for: an address of the web (external), or a file (size and SHA-256) or folder (number of files and their size) under root or at a full path; available says if it is there.
    Hidden files and those that begin with _ aren't counted."""
    if ref.startswith(("http://", "https://", "ftp://")):
        return {"ref": ref, "kind": "external", "available": True}
    full = ref if ref.startswith("/") or "://" in ref else f"{root}/{ref}"
    fs, at = _fs(spark, full)
    out = {"ref": ref, "kind": "dataset", "available": bool(fs.exists(at))}
    if not out["available"]:
        return out
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(full)
    if fs.getFileStatus(at).isFile():
        size, digest = files.select("length", F.sha2("content", 256)).first()  # hashed where it is read
        return out | {"size_bytes": size, "sha256": digest}
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first() if fs.getContentSummary(at).getFileCount() else (0, 0)
    return out | {"file_count": n, "size_bytes": size}


class Run:
    """A manifest at root/runs/<run_id>.json, written anew after each stage, and root/runs/latest.json, which names the last one."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, pipeline: str, parent: str | None = None):
        self.spark, self.root = spark, root
        self.record = {"schema_version": "1.0", "run_id": checked_run_id(run_id), "pipeline": pipeline, "parent_run_id": parent, "status": "running", "started_at": _now(), "finished_at": None, "stages": [], "quality": None, "error": None}
        self._persist()

    @property
    def path(self) -> str:
        return f"{self.root}/runs/{self.record['run_id']}.json"

    def _persist(self) -> None:
        write_text(self.spark, self.path, json.dumps(self.record, ensure_ascii=False, sort_keys=True))
        latest = {"run_id": self.record["run_id"], "pipeline": self.record["pipeline"], "status": self.record["status"], "manifest": f"{self.record['run_id']}.json", "updated_at": self.record["finished_at"] or self.record["started_at"]}
        write_text(self.spark, f"{self.root}/runs/latest.json", json.dumps(latest, ensure_ascii=False, sort_keys=True))

    def write(self, name: str, df: DataFrame, output: str, inputs: Sequence[str] = (), metrics: Mapping[str, Column] | None = None) -> DataFrame:
        """Writes a stage's rows as Parquet under root and notes their number and `metrics` (aggregates), observed as the rows go by; returns the table read back."""
        observed = Observation(f"{self.record['run_id']}.{name}.{len(self.record['stages'])}")
        df.observe(observed, F.count(F.lit(1)).alias("_rows"), *[c.alias(m) for m, c in (metrics or {}).items()]).write.mode("overwrite").parquet(f"{self.root}/{output}")
        found = dict(observed.get)
        self.stage(name, inputs, [output], found.pop("_rows"), found)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{output}")

    def stage(self, name: str, inputs: Sequence[str] = (), outputs: Sequence[str] = (), rows: int | None = None, metrics: Mapping | None = None) -> None:
        """Notes a stage that is done."""
        refer = lambda names: [reference(self.spark, self.root, n) for n in names]
        told = {k: None if v is None else str(v) for k, v in (metrics or {}).items()}
        self.record["stages"].append({"name": name, "status": "succeeded", "completed_at": _now(), "rows": rows, "metrics": told, "inputs": refer(inputs), "outputs": refer(outputs)})
        self._persist()

    def finish(self, status: str = "succeeded", quality: dict | None = None, error: str | None = None) -> None:
        self.record |= {"status": status, "finished_at": _now(), "quality": quality, "error": error}
        self._persist()

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind, error, _) -> None:
        """A run that an error ends is failed; one that nobody finished has succeeded."""
        if error is not None:
            self.finish("failed", error=f"{kind.__name__}: {error}")
        elif self.record["finished_at"] is None:
            self.finish()


def stages(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, status, number, name, rows, metrics, inputs, outputs) of a manifest, or of all under a folder's pattern."""
    runs = spark.read.schema(f"run_id string, status string, {STAGES}").option("multiLine", True).json(path)
    return runs.select("run_id", "status", F.posexplode("stages").alias("number", "s")).select("run_id", "status", "number", "s.name", "s.rows", "s.metrics", "s.inputs", "s.outputs")


def latest(spark: SparkSession, root: str) -> dict | None:
    found = read_text(spark, f"{root}/runs/latest.json")
    return None if found is None else json.loads(found)
