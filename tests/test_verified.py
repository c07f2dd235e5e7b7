"""Copies that agree with their source, slice by slice."""

import hashlib
from glob import glob

import pytest
from pyspark.sql import functions as F

from ferryline import TransferError
from ferryline.operators.slices import slice_number
from ferryline.plans.verified import copy_verified, differing_slices, read_copy, slice_digests


def by_id(df):
    return slice_number(df, "id", 4)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_digests_see_multisets(spark):
    def digests(*values):
        df = spark.createDataFrame([(0, *v) for v in values], "id int, a string, b string")
        return slice_digests(df.repartition(3), F.lit(0).cast("int"))

    base = digests(("x", None), ("y", "z"), ("y", "z"))
    assert differing_slices(base, digests(("y", "z"), ("x", None), ("y", "z"))) == []
    for other in (digests(("x", None), ("y", "z")), digests((None, "x"), ("y", "z"), ("y", "z")),
                  digests(("x", None), ("x", None), ("y", "z")), digests(("x", ""), ("y", "z"), ("y", "z"))):
        assert differing_slices(base, other) == [0]


def test_only_slices_that_differ_are_read_again(spark, new_dir):
    """A row is changed, one is added and one deleted between the reads."""
    before = spark.range(100).select("id", F.lit("a").alias("s"))
    after = before.where("id <> 9").withColumn("s", F.when(F.col("id") == 4, "b").otherwise(F.col("s"))).unionAll(
        spark.range(100, 101).select("id", F.lit("a")))
    reads, path, kept = [], new_dir(), {}

    def read():
        reads.append(1)
        if len(reads) == 2:
            kept.update({f: hashlib.sha256(open(f, "rb").read()).hexdigest() for f in glob(f"{path}/*/part-*")})
        return before if len(reads) == 1 else after

    report = copy_verified(spark, read, by_id, path)
    assert report == {"rounds": 2, "repaired": [0, 1]}
    assert rows(read_copy(spark, path, before.schema)) == rows(after)
    for f, digest in kept.items():
        if "slice=2" in f or "slice=3" in f:
            assert hashlib.sha256(open(f, "rb").read()).hexdigest() == digest


def test_a_slice_that_becomes_empty(spark, new_dir):
    frames, path = [spark.range(20), spark.range(20).where("id % 4 <> 1")], new_dir()
    report = copy_verified(spark, lambda: frames.pop(0) if len(frames) > 1 else frames[0], by_id, path)
    assert report["repaired"] == [1]
    assert rows(read_copy(spark, path, spark.range(1).schema)) == sorted(((i,) for i in range(20) if i % 4 != 1), key=str)


def test_a_source_that_never_rests(spark, new_dir):
    n = [10]

    def read():
        n[0] += 1
        return spark.range(n[0])

    with pytest.raises(TransferError, match="still differ"):
        copy_verified(spark, read, by_id, new_dir(), rounds=2)


def test_clean_copies_are_compared_once(spark, new_dir):
    df = spark.createDataFrame([(1, None), (1, None), (None, "x")], "id int, s string")
    path = new_dir()
    assert copy_verified(spark, lambda: df, by_id, path) == {"rounds": 1, "repaired": []}
    assert rows(read_copy(spark, path, df.schema)) == rows(df)
