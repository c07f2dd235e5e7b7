"""Update by key: semantics, repeated keys, skew."""

from glob import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ferryline import one_row_per_key, update_by_key, updated_by_key
from ferryline.shared import shared_dir


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (2, "b2", 21), (None, "n", 0)], "k int, s string, v bigint"
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_update_sets_matching_rows_only(spark, target):
    changes = spark.createDataFrame([(2, 5), (9, 6), (None, 7), (None, 8)], "k int, v int")
    assert rows(update_by_key(target, changes, ["k"])) == rows(spark.createDataFrame(
        [(1, "a", 10), (2, "b", 5), (2, "b2", 5), (None, "n", 0)], target.schema))


def test_updated_by_key_deletes_its_stored_changes(spark, target):
    changes = spark.createDataFrame([(2, 5)], "k int, v int")
    stored = f"{shared_dir(spark)}/changes-*"
    before = set(glob(stored))
    with updated_by_key(target, changes, ["k"]) as updated:
        assert rows(updated) == rows(update_by_key(target, changes, ["k"]))
        during = set(glob(stored))
    assert len(during - before) == 2 and len(set(glob(stored)) - before) == 1
    with pytest.raises(PySparkException, match="several changes"):
        with updated_by_key(target, changes.unionAll(changes), ["k"]):
            pass
    assert len(set(glob(stored)) - before) == 1


def test_update_to_null(spark, target):
    changes = spark.createDataFrame([(1, None, None)], "k int, s string, v bigint")
    assert (1, None, None) in rows(update_by_key(target, changes, ["k"]))


def test_composite_keys(spark, target):
    changes = spark.createDataFrame([(2, "b2", 99)], "k int, s string, v bigint")
    got = rows(update_by_key(target, changes, ["k", "s"]))
    assert (2, "b2", 99) in got and (2, "b", 20) in got


def test_repeated_keys_need_an_order(spark, target):
    changes = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (2, 7, 1)], "k int, v bigint, at int")
    with pytest.raises(PySparkException, match="several changes"):
        update_by_key(target, changes.drop("at"), ["k"])
    got = rows(update_by_key(target, changes, ["k"], order_by=["at"]))
    assert (1, "a", 6) in got and (2, "b", 7) in got


def test_unlike_ties_fail_and_equal_ones_do_not(spark, target):
    tied = spark.createDataFrame([(1, 5, 1), (1, 6, 1), (1, 4, 0)], "k int, v bigint, at int")
    with pytest.raises(PySparkException, match="tie"):
        update_by_key(target, tied, ["k"], order_by=["at"])
    same = spark.createDataFrame([(1, 6, 1), (1, 6, 1), (1, 4, 0)], "k int, v bigint, at int")
    assert rows(one_row_per_key(same, ["k"], ["at"])) == [(1, 6)]


def test_unknown_columns(spark, target):
    changes = spark.createDataFrame([(1, 5)], "k int, other int")
    with pytest.raises(ValueError, match="not in the target"):
        update_by_key(target, changes, ["k"])
    with pytest.raises(ValueError, match="no columns"):
        update_by_key(target, changes.select("k"), ["k"])


def test_large_changes_are_not_broadcast_and_hot_keys_are_split(spark, new_dir):
    """A key that holds a third of the rows is split among tasks by the plan."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    path = new_dir("big")
    spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("s"), F.col("id").alias("v"),
    ).repartition(8).write.parquet(path)
    target = spark.read.parquet(path)
    changes = spark.range(50_000).selectExpr("id as k", "-id as v")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        updated = update_by_key(target, changes, ["k"])
        got = updated.agg(F.count("*"), F.sum("v")).collect()
        updated.write.format("noop").mode("overwrite").save()
        df = updated.where("length(s) > 1")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in plan and "Broadcast" not in plan
    expected = target.selectExpr(
        "count(*)", "sum(if(k < 50000, -k, v))"
    ).collect()
    assert list(map(tuple, got)) == list(map(tuple, expected))


def test_dotted_names_and_names_of_helper_columns(spark):
    target = spark.createDataFrame([(1, "a", "b", 0), (2, "c", "d", 0)], "`k.y` int, `_row` string, `v``x` string, `_hash` int")
    changes = spark.createDataFrame(
        [(1, "A", "old", 1), (1, "B", "new", 2), (None, "N", "N", 3)],
        "`k.y` int, `_row` string, `v``x` string, `_high.at` int")
    got = update_by_key(target, changes, ["k.y"], order_by=["_high.at"])
    assert got.columns == target.columns
    assert sorted(map(tuple, got.collect())) == [(1, "B", "new", 0), (2, "c", "d", 0)]
    keyed = spark.createDataFrame([(7, "x")], "`_row` int, v string")
    assert update_by_key(keyed, spark.createDataFrame([(7, "y")], "`_row` int, v string"), ["_row"]).first()["v"] == "y"
