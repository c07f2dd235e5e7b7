"""Budgets that stop a job while it runs, and where rejects come from."""

import gzip
import os
import time
from glob import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline import Directory, LoadOptions, RejectBudgetExceeded, load
from ferryline.plans.watch import BudgetReached, RejectWatch

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("val", T.IntegerType())])


def write_files(folder, files):
    os.makedirs(folder)
    for name, lines in files.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write("".join(line + "\n" for line in lines))
    return folder


def test_a_bad_file_first_spares_most_tasks(spark, new_dir):
    """64 slow tasks of one partition each; the first ones alone pass the budget."""
    ran = spark.sparkContext.accumulator(0)

    def slow(batches):
        ran.add(1)
        for batch in batches:
            time.sleep(0.3)
            yield batch

    watch = RejectWatch(spark, 10)
    rows = spark.range(0, 640, 1, 64).mapInPandas(slow, "id long")
    flagged = rows.withColumn("bad", watch.counted(F.col("id") % 10 < 4))
    path = new_dir()
    with pytest.raises(BudgetReached):
        watch.run(lambda: flagged.write.parquet(path))
    assert 10 <= watch.rejected and ran.value < 48
    assert not glob(f"{path}/part-*")


def test_a_task_ends_at_the_budget_by_itself(spark, new_dir):
    watch = RejectWatch(spark, 5)
    flagged = spark.range(0, 10**6, 1, 1).withColumn("bad", watch.counted(F.col("id") >= 0))
    with pytest.raises(BudgetReached):
        watch.run(lambda: flagged.write.parquet(new_dir()))


def test_other_errors_and_clean_jobs_pass_through(spark, new_dir):
    watch = RejectWatch(spark, 5)
    rows = spark.range(100).withColumn("bad", watch.counted(F.col("id") < 4))
    watch.run(lambda: rows.write.parquet(new_dir()))
    assert (watch.read, watch.rejected) == (100, 4)
    with pytest.raises(ZeroDivisionError):
        watch.run(lambda: 1 / 0)
    assert not spark.sparkContext.getJobTags()


@pytest.fixture
def small_tasks(spark):
    for key, value in (("maxPartitionBytes", "64k"), ("openCostInBytes", "0")):
        spark.conf.set(f"spark.sql.files.{key}", value)
    yield
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def test_load_stops_early_and_reports_its_first_rejects(spark, new_dir, small_tasks):
    """Hundreds of tasks; the bad file's is the first, and the summary shows most lines were not read."""
    files = {f"part-{i:02}": [f"{k},1" for k in range(200_000)] for i in range(24)}
    path, target, shared = write_files(new_dir("in"), files), new_dir("target"), new_dir("rejects")
    with gzip.open(f"{path}/part-bad.gz", "wt") as f:  # one task, and the largest: Spark begins with it
        f.write("".join(f"{k * 7919 % 999_983},x\n" for k in range(100_000)))
    assert spark.read.text(path).rdd.getNumPartitions() > 200
    with pytest.raises(RejectBudgetExceeded, match="stopped") as failed:
        load(spark, path, Directory(target), LoadOptions(max_errors=50, rejects_path=shared), schema=SCHEMA)
    summary = failed.value.summary
    assert summary["aborted"] and summary["rows_loaded"] == 0
    assert summary["rows_rejected"] == 50 and summary["by_reason"] == {"invalid_integer": 50}
    assert summary["rows_read"] < sum(map(len, files.values())) // 2
    rejects = spark.read.json(f"{shared}/rejects")
    assert rejects.count() == 50
    assert {os.path.basename(r[0]) for r in rejects.select("_source_file").distinct().collect()} == {"part-bad.gz"}
    assert spark.read.json(f"{shared}/summary").select("aborted").first()[0]
    assert not os.path.exists(target)


def test_rejects_name_file_block_and_partition(spark, new_dir):
    path = write_files(new_dir("in"), {"a": ["1,x", "2,2"], "b": ["3,y"] * 3})
    shared = new_dir("rejects")
    load(spark, path, Directory(new_dir()), LoadOptions(max_errors=99, rejects_path=shared), schema=SCHEMA)
    rejects = spark.read.json(f"{shared}/rejects").collect()
    assert sorted((os.path.basename(r["_source_file"]), r["_source_block"], r["raw"]) for r in rejects) == [
        ("a", 0, "1,x"), *[("b", 0, "3,y")] * 3]
    assert all(r["_source_partition"] >= 0 for r in rejects)


def test_blocks_of_one_file_are_told_apart(spark, new_dir, small_tasks):
    path = write_files(new_dir("in"), {"a": [f"{k},{'x' if k % 1000 == 0 else 1}" for k in range(20_000)]})
    shared = new_dir("rejects")
    load(spark, path, Directory(new_dir()), LoadOptions(max_errors=99, rejects_path=shared), schema=SCHEMA)
    rejects = spark.read.json(f"{shared}/rejects")
    assert rejects.count() == 20 and rejects.select("_source_block").distinct().count() > 2
