"""Sources, snapshots and streams on small files."""

import pytest
from pyspark.sql import functions as F

from lectern import queries
from lectern.plans import snapshots
from lectern.sources import catalog, files
from lectern.streaming import ingest


def test_jsonl_and_csv(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n{"a": 2}\nnot json\n')
    assert files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a int", bad="skip").count() == 2
    with pytest.raises(Exception):  # noqa: B017
        files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a int").collect()
    assert files.read_jsonl(spark, str(tmp_path / "none.jsonl"), "a int", missing="empty").count() == 0
    (tmp_path / "b.csv").write_text('﻿id,text,n,list\n1,"two\nlines ""quoted""",1.5,"[1,2]"\n2,,x,bad\n', encoding="utf-8")
    rows = files.typed(files.read_csv(spark, str(tmp_path / "b.csv"), ["id", "text", "n", "list"]), ["n"], {"list": "array<int>"}).collect()
    assert [tuple(r) for r in rows] == [("1", 'two\nlines "quoted"', 1.5, [1, 2]), ("2", "", None, [])]
    files.write_csv(spark.createDataFrame([(1, [1, 2], None)], "b int, a array<int>, c string"), str(tmp_path / "out"))
    assert "a,b,c" in next((tmp_path / "out").glob("*.csv")).read_text()


def test_documents(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "y.bin").write_bytes(b"zz")
    assert {r.kind for r in files.read_documents(spark, str(tmp_path)).collect()} == {"pdf", "unknown"}


def test_catalog(spark):
    page = '<a href="/p/1">01.03.01  Math</a><a href="http://H/p/1#x">again</a><a href="/p/2">02.03.04 Law</a><a rel="next" href="?page=2">more</a>'
    links = catalog.page_links(spark.createDataFrame([(1, "http://h/", page), (2, "http://h/", None)], "id int, u string, h string"), "id", "u", "h")
    assert [r.link for r in links.where("is_next").collect()] == ["http://h/?page=2"]
    assert sorted((r.address, r.code) for r in catalog.catalog(links).collect()) == [("http://h/p/1", "01.03.01"), ("http://h/p/2", "02.03.04")]


def test_offsets(spark):
    class Numbers(catalog.Offsets):
        fields = "value int"

        @classmethod
        def name(cls):
            return "numbers"

        fetch = staticmethod(lambda offset, limit: [(i,) for i in range(offset, min(offset + limit, 25))])

    spark.dataSource.register(Numbers)
    df = spark.read.format("numbers").option("total", 25).option("page", 10).load()
    assert sorted(r.value for r in df.collect()) == list(range(25))
    assert df.rdd.getNumPartitions() == 3


def test_publish(spark, tmp_path):
    root = str(tmp_path / "store")
    good = spark.createDataFrame([("a",), ("b",)], "id string")
    assert snapshots.active(spark, root) is None
    assert snapshots.publish(spark, root, "run-1", {"things": good}, ("things",))["passed"]
    first = snapshots.active(spark, root)
    assert files.read_snapshot(spark, first, ["things", "absent"])["things"].count() == 2
    report = snapshots.publish(spark, root, "run-2", {"things": good.union(good)})
    assert not report["passed"] and snapshots.active(spark, root) == first
    assert not (tmp_path / "store/snapshots/run-2").exists()
    for bad in ("../x", "", "a/b"):
        with pytest.raises(ValueError):
            snapshots.publish(spark, root, bad, {})
    with pytest.raises(ValueError):
        snapshots.publish(spark, root, "run-1", {"things": good})


def test_resume(spark):
    inputs = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2")], "key string, fingerprint string")
    ledger = snapshots.ledger_of(inputs.where("key = 'a'"), "key", "fingerprint").unionByName(spark.createDataFrame([("c", "1")], "key string, fingerprint string").withColumn("marked_at", F.current_timestamp()))
    assert {r.key for r in snapshots.resume(inputs, ledger, "key", "fingerprint", lambda df: df).collect()} == {"b", "c"}
    assert snapshots.config_hash({"b": 1, "a": 2}) == snapshots.config_hash({"a": 2, "b": 1})


def test_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.sql("select 1 as k, timestamp'2024-01-01 00:00:00' as ts union all select 1, timestamp'2024-01-01 00:10:00' union all select 2, timestamp'2024-01-01 00:00:00'").write.parquet(source)
    stream = ingest.new_rows(spark, source, "k int, ts timestamp")
    ingest.run_once(ingest.first_per_key(stream, ["k"], "ts", "1 hour"), str(tmp_path / "c1"), lambda df, i: df.write.mode("append").parquet(out)).awaitTermination(120)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2]
    counted = []
    ingest.run_once(ingest.windowed_counts(stream, "ts", "1 hour", "1 hour", "k"), str(tmp_path / "c2"), lambda df, i: counted.extend(df.collect())).awaitTermination(120)


def test_queries_run_on_the_smallest_tables(spark):
    for name, q in queries.QUERIES.items():
        df = q(spark, "/root/testdata/sf0.001")
        assert df.columns, name
        df.limit(3).collect()
