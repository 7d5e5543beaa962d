"""Digests by range, and records of runs and batches."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.operators import digests as D
from tessera.operators.snapshot import SnapshotError
from tessera.sinks.collections import publish_all, run_tree
from tessera.sinks.tablelog import TableLog
from tessera.sources import readers as R
from tessera.streaming import ingest as I
from tessera.streaming.progress import BatchRecords, totals
from tests.test_operators import SCHEMA, frame


def changed_table(spark):
    base = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"), F.lit(None).cast("string").alias("n")).unionByName(spark.createDataFrame([(None, 1, "x"), (7, 21, None)], "k long, v long, n string"))
    other = base.where("k is null or k <> 100").withColumn("v", F.when(F.col("k") == 200, -1).otherwise(F.col("v"))).unionByName(spark.createDataFrame([(5000, 1, "new")], "k long, v long, n string"))
    return base, other


def test_changes_read_only_ranges_that_differ(spark, tmp_path):
    base, other = changed_table(spark)
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    a, b = D.seal(base, old, "k", ranges=32), D.seal(other.repartition(5), new, "k", ranges=32)
    ranges = D.differing(a, b)
    assert ranges == sorted({r[0] for r in spark.createDataFrame([(100,), (200,), (5000,)], "k long").select(D.range_of("k", ranges=32)).collect()})
    want = {(100, "removed"), (200, "changed"), (5000, "added")}
    assert {tuple(r) for r in D.changes(spark, old, new, "k").collect()} == want
    # a range that doesn't differ isn't read: it can be gone
    for r in set(range(32)) - set(ranges):
        for path in (old, new):
            (file,) = Path(path, "rows", f"{D.RANGE}={r}").glob("*.parquet")
            file.write_bytes(b"not read")
    rows = D.changes(spark, old, new, "k").collect()
    assert {tuple(r) for r in rows} == want


def test_equal_tables_have_no_changes(spark, tmp_path):
    base, _ = changed_table(spark)
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    D.seal(base, old, "k"), D.seal(base.repartition(7), new, "k")
    assert D.changes(spark, old, new, "k").count() == 0 and D.damaged(spark, old) == []
    gone = next(Path(old, "rows").glob(f"{D.RANGE}=*"))
    shutil.rmtree(gone)
    assert D.damaged(spark, old) == [int(gone.name.split("=")[1])]
    with pytest.raises(Exception, match="already exists"):
        D.seal(base, old, "k")
    with pytest.raises(SnapshotError):
        D.seal(base.withColumn(D.RANGE, F.lit(1)), str(tmp_path / "x"), "k")


def test_coarser_digests_are_sums(spark, tmp_path):
    base, _ = changed_table(spark)
    fine = D.seal(base, str(tmp_path / "t"), "k", ranges=64)
    got = {tuple(r) for r in D.coarser(fine, 8).collect()}
    assert got == {tuple(r) for r in D.digests(base, F.floor(D.range_of("k", ranges=64) / 8).cast("int")).collect()}
    assert D.seal(base.limit(0), str(tmp_path / "e"), "k").count() == 0
    assert {r["change"] for r in D.changes(spark, str(tmp_path / "e"), str(tmp_path / "t"), "k").collect()} == {"added"}


def test_run_tree(spark, tmp_path):
    log = TableLog(spark, str(tmp_path / "log"))
    good = frame(spark, {"id": "1", "type": "Extraction", "inputs": ["a", "b"]}, {"id": "2"})
    tree = {r["run"]: r for r in run_tree(spark, "night", publish_all(log, {"process_set": good, "record_set": frame(spark, {"id": "r", "depth": "a secret"})}, SCHEMA)).collect()}
    assert (tree["night"]["status"], tree["night"]["rows_read"], tree["night"]["rows_written"]) == ("failed", 2, 4)
    assert (tree["process_set"]["parent"], tree["process_set"]["rows_read"], tree["process_set"]["rows_written"]) == ("night", 2, 4)
    assert (tree["process_set/process_set_inputs"]["parent"], tree["process_set/process_set_inputs"]["rows_written"]) == ("process_set", 2)
    assert tree["record_set"]["status"] == "failed" and tree["record_set"]["error"] and "secret" not in str(tree["record_set"])
    assert tree["process_set"]["rows_per_second"] > 0


def test_batches_of_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = "g\t1\tK1\t99.5\t1\t2\t3\t4\t1e-5\t50\t7\n"
    (tmp_path / "in" / "a.tsv").write_text(line * 3)

    def fail(lines):
        rows, bad = R.blast(lines)
        return rows.withColumn("gene_id", F.raise_error(F.lit("a secret")).cast("string")), bad

    with BatchRecords(spark) as records:
        good = I.ingest(spark, str(tmp_path / "in"), R.blast, str(tmp_path / "out"), str(tmp_path / "c1"))
        good.awaitTermination(120)
        bad = I.ingest(spark, str(tmp_path / "in"), fail, str(tmp_path / "out2"), str(tmp_path / "c2"))
        with pytest.raises(Exception):  # noqa: B017
            bad.awaitTermination(120)
        assert records.wait_for(good, bad)
        runs = records.runs({str(good.runId): "good", str(bad.runId): "bad"})
    found = {r["run"]: r for r in runs.collect()}
    assert (found["good"]["status"], found["good"]["rows_read"] >= 3, found["good/0"]["parent"]) == ("success", True, "good")
    assert found["bad"]["status"] == "failed" and found["bad"]["error"] and "secret" not in found["bad"]["error"]
    (all_,) = totals(runs).collect()
    assert (all_["runs"], all_["failed"]) == (2, 1)
