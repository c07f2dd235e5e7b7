"""Loads that are published once, and updates that write touched files only."""

import hashlib
import os
import threading
from glob import glob

import pytest
from pyspark.sql import functions as F

from ferryline import (
    LoadOptions, Published, RejectBudgetExceeded, TransferError, load, publish, recover, update_by_key,
    update_files,
)
from ferryline.plans import rewrite


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------ publication

def test_a_load_id_is_published_once(spark, new_dir):
    target, df = Published(new_dir()), spark.range(10)
    assert target.read(spark, df.schema).count() == 0
    assert publish(df, target, "a") and not publish(df, target, "a")
    assert publish(df.where("id < 3"), target, "b-1.x")
    assert target.load_ids(spark) == ["a", "b-1.x"]
    assert rows(target.read(spark, df.schema)) == rows(df.unionAll(df.where("id < 3")))
    assert not glob(f"{target.path}/_staging*")


def test_a_failing_task_shows_nothing(spark, new_dir):
    target = Published(new_dir())
    publish(spark.range(5), target, "good")
    broken = spark.range(0, 100, 1, 10).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish(broken, target, "bad")
    assert target.load_ids(spark) == ["good"] and target.read(spark, spark.range(1).schema).count() == 5
    assert not glob(f"{target.path}/_staging*")
    assert publish(spark.range(7), target, "bad")  # the same load again


def test_of_two_writers_one_is_published(spark, new_dir, monkeypatch):
    from ferryline.sinks import published

    target, both, done = Published(new_dir()), threading.Barrier(2), []
    move = published.move_new
    monkeypatch.setattr(published, "move_new", lambda *a: (both.wait(60), move(*a))[1])

    def write(n):
        done.append((publish(spark.range(n), target, "x"), n))

    threads = [threading.Thread(target=write, args=(n,)) for n in (3, 4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(ok for ok, _ in done) == [False, True]
    winner = next(n for ok, n in done if ok)
    assert target.read(spark, spark.range(1).schema).count() == winner
    assert not glob(f"{target.path}/_staging*")


def test_loads_by_id(spark, new_dir):
    schema = spark.createDataFrame([], "a int, b string").schema
    path, target = new_dir("in"), Published(new_dir())
    os.makedirs(path)
    with open(f"{path}/f", "w") as f:
        f.write("1,x\n2,y\n")
    first = load(spark, path, target, schema=schema, load_id="one")
    again = load(spark, path, target, schema=schema, load_id="one")
    assert (first["rows_loaded"], again["rows_loaded"], first["load_id"]) == (2, 0, "one")
    with open(f"{path}/g", "w") as f:
        f.write("bad,x\n")
    for opts in (LoadOptions(), LoadOptions(max_errors=2)):
        if opts.max_errors == 1:
            with pytest.raises(RejectBudgetExceeded):
                load(spark, path, target, opts, schema=schema, load_id="two")
            assert target.load_ids(spark) == ["one"]
        else:
            assert load(spark, path, target, opts, schema=schema, load_id="two")["rows_loaded"] == 2
    assert rows(target.read(spark, schema)) == [(1, "x"), (1, "x"), (2, "y"), (2, "y")]
    with pytest.raises(ValueError, match="load_id"):
        load(spark, path, target, schema=schema)
    with pytest.raises(ValueError, match="load id"):
        publish(spark.range(1), target, "../x")


# ------------------------------------------------------------------ touched files

def files(path):
    """Names and bytes of the data files."""
    found = glob(f"{path}/**/part-*", recursive=True)
    return {f: hashlib.sha256(open(f, "rb").read()).hexdigest() for f in found}


@pytest.fixture
def table(spark, new_dir):
    path = new_dir("table")
    spark.range(1000).select("id", F.col("id").cast("string").alias("s"), F.lit(0).alias("v")).repartitionByRange(
        10, "id").write.parquet(path)
    return path


def test_untouched_files_keep_name_and_bytes(spark, table):
    before, plain = files(table), spark.read.parquet(table)
    changes = spark.createDataFrame([(5, 1), (6, 2), (950, 3), (5000, 9), (None, 4)], "id long, v int")
    expected = rows(update_by_key(plain, changes, ["id"]))
    assert update_files(spark, table, changes, ["id"]) == {"touched": 2, "added": 2}
    after = files(table)
    assert len(before) == len(after) == 10
    assert len(before.items() & after.items()) == 8
    assert rows(spark.read.parquet(table)) == expected
    assert not glob(f"{table}/_staging*") and not os.path.exists(f"{table}/{rewrite.JOURNAL}")


def test_changes_that_match_nothing_write_nothing(spark, table):
    before = files(table)
    changes = spark.createDataFrame([(5000, 9), (None, 4)], "id long, v int")
    assert update_files(spark, table, changes, ["id"]) == {"touched": 0, "added": 0}
    assert files(table) == before


def test_partition_folders(spark, new_dir):
    path = new_dir("table")
    spark.range(60).select("id", (F.col("id") % 3).alias("v"), F.concat(F.lit("d %"), F.col("id") % 4).alias("day")) \
        .write.partitionBy("day").parquet(path)
    before = files(path)
    changes = spark.createDataFrame([(4, 100), (8, 200)], "id long, v long")
    update_files(spark, path, changes, ["id"])
    got = spark.read.parquet(path)
    assert rows(got.where("id in (4, 8)").select("id", "v", "day")) == [(4, 100, "d %0"), (8, 200, "d %0")]
    assert got.count() == 60 and all(
        f in files(path) for f in before if "day=d %250" not in f and "day=d %0" not in f)
    moved = spark.createDataFrame([(4, "d %1")], "id long, day string")
    update_files(spark, path, moved, ["id"])
    assert rows(spark.read.parquet(path).where("id = 4").select("v", "day")) == [(100, "d %1")]
    assert spark.read.parquet(path).count() == 60


def test_an_update_that_broke_off_is_completed(spark, table, monkeypatch):
    changes = spark.createDataFrame([(5, 1), (950, 3)], "id long, v int")
    expected = rows(update_by_key(spark.read.parquet(table), changes, ["id"]))
    calls, delete = [], rewrite.delete_path

    def broken(spark_, path):
        if "part-" in path:
            calls.append(path)
            if len(calls) == 2:
                raise OSError("the driver is lost")
        delete(spark_, path)

    monkeypatch.setattr(rewrite, "delete_path", broken)
    with pytest.raises(OSError):
        update_files(spark, table, changes, ["id"])
    monkeypatch.setattr(rewrite, "delete_path", delete)
    assert os.path.exists(f"{table}/{rewrite.JOURNAL}")
    assert recover(spark, table) and not recover(spark, table)
    assert rows(spark.read.parquet(table)) == expected and len(files(table)) == 10


def test_two_updates_of_one_file(spark, table, monkeypatch):
    """The second one is committed while the first one writes; the first changes nothing."""
    move, begun = rewrite.move_new, []

    def late(spark_, source, target):
        if target.endswith(rewrite.JOURNAL) and not begun:
            begun.append(1)
            update_files(spark, table, spark.createDataFrame([(7, 70)], "id long, v int"), ["id"])
        return move(spark_, source, target)

    monkeypatch.setattr(rewrite, "move_new", late)
    with pytest.raises(TransferError, match="meanwhile"):
        update_files(spark, table, spark.createDataFrame([(5, 50)], "id long, v int"), ["id"])
    got = spark.read.parquet(table)
    assert rows(got.where("v <> 0").select("id", "v")) == [(7, 70)] and got.count() == 1000
    assert not glob(f"{table}/_*-*")


def test_an_update_under_way_is_not_disturbed(spark, table, monkeypatch):
    monkeypatch.setattr(rewrite, "move_new", lambda *a: False)
    before = files(table)
    with pytest.raises(TransferError, match="under way"):
        update_files(spark, table, spark.createDataFrame([(5, 50)], "id long, v int"), ["id"])
    assert files(table) == before and not glob(f"{table}/_staging*")
