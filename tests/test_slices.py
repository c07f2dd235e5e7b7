"""Slices add up to the table, whatever the keys."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from ferryline import bounds, incremental, incremental_condition, slice_df
from ferryline.operators import slices

KEYS = [None, -9, -8, -3, -1, 0, 1, 2, 3, 7, 8, 100, None, 2**40]


@pytest.fixture
def keyed(spark):
    return spark.createDataFrame([(i, k) for i, k in enumerate(KEYS)], "id int, `Key` bigint")


@pytest.fixture
def ansi_names(spark):
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    yield
    spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 8])
def test_modulo_predicates_partition_the_table(keyed, ansi_names, n):
    parts = [ids(keyed.where(p)) for p in slices.modulo_predicates("Key", n)]
    assert len(parts) == n
    assert sorted(sum(parts, [])) == list(range(len(KEYS)))


def test_several_keys_split_a_hot_one(spark, ansi_names):
    hot = spark.range(3000).selectExpr("id", "if(id % 3 = 0, null, 7) as k", "-id as other")
    parts = [ids(hot.where(p)) for p in slices.modulo_predicates(["k", "other"], 8)]
    assert sorted(sum(parts, [])) == list(range(3000))
    assert max(map(len, parts)) < 2 * 3000 / 8


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_range_predicates_partition_the_table(keyed, ansi_names, n):
    predicates = slices.range_predicates("Key", -9, 100, n)
    parts = [ids(keyed.where(p)) for p in predicates]
    assert sorted(sum(parts, [])) == list(range(len(KEYS)))
    numbered = keyed.select("id", slices.range_slice_number(F.col("Key"), -9, 100, n).alias("s"))
    for i, part in enumerate(parts):
        assert ids(numbered.where(F.col("s") == i)) == part


def test_range_predicates_over_time(spark, ansi_names):
    df = spark.range(1000).selectExpr(
        "cast(id as int) id", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, id) as `At`"
    )
    lo, hi = bounds(df, "At").first()
    parts = [ids(df.where(p)) for p in slices.range_predicates("At", lo, hi, 7)]
    assert all(parts) and sorted(sum(parts, [])) == list(range(1000))


def test_user_condition_cannot_escape_its_slice(keyed, ansi_names):
    where = '"id" = 3 OR "Key" > 1'
    predicates = slices.and_condition(slices.modulo_predicates("Key", 4), where)
    parts = [ids(keyed.where(p)) for p in predicates]
    assert sorted(sum(parts, [])) == ids(keyed.where(where))
    assert slices.and_condition(["a = 1"], None) == ["a = 1"]


def test_system_slices():
    assert slices.modulo_predicates("SLICE_ID", 2, system_key=True) == [
        "MOD(SLICE_ID, 2) = 0", "MOD(SLICE_ID, 2) = 1"
    ]
    with pytest.raises(ValueError):
        slices.modulo_predicates("k", 0)


def test_slice_numbers(spark, keyed):
    got = {r["id"]: r["slice"] for r in slice_df(keyed, "Key", 4).collect()}
    assert got == {i: 0 if k is None else k % 4 for i, k in enumerate(KEYS)}
    hashed = slice_df(keyed, ["Key", "id"], 4).collect()
    assert {r["slice"] for r in hashed} <= set(range(4)) and len(hashed) == len(KEYS)


def test_a_hot_key_spreads_over_slices(spark):
    hot = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 7, id) as k")
    counts = [r["count"] for r in slice_df(hot, ["k", "id"], 8).groupBy("slice").count().collect()]
    assert len(counts) == 8 and max(counts) < 2 * 4000 / 8


def test_slicing_moves_no_rows(spark):
    df = slice_df(spark.range(10), "id", 4)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_bounds_refuse_booleans(spark):
    with pytest.raises(ValueError, match="boolean"):
        bounds(spark.sql("select true b"), "b")


def test_incremental(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    first, mark = incremental(spark.read.parquet(path), "id")
    assert (first.count(), mark) == (10, 9)
    spark.range(10, 25).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    batch, new_mark = incremental(table, "id", mark)
    spark.range(25, 30).write.mode("append").parquet(path)
    assert sorted(r[0] for r in batch.collect()) == list(range(10, 25)) and new_mark == 24
    pushed = batch._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,9)" in pushed and "LessThanOrEqual(id,24)" in pushed
    nothing, same = incremental(table, "id", 24)
    assert (nothing.count(), same) == (0, 24)


def test_incremental_condition():
    at = datetime.datetime(2020, 1, 2, 3, 4, 5)
    assert incremental_condition("ts", None, at) == "\"ts\" <= TIMESTAMP '2020-01-02 03:04:05'"
    assert incremental_condition("id", 3, 9) == '"id" > 3 AND "id" <= 9'


@pytest.mark.parametrize("process_zone", ["America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("day", ["2024-03-10", "2024-11-03"])
def test_batches_lose_nothing_in_any_zone(spark, monkeypatch, process_zone, session_zone, kind, day):
    """Half-hourly rows over a clock change, read in batches as the table grows."""
    monkeypatch.setenv("TZ", process_zone)
    time.tzset()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        at = (f"timestampadd(MINUTE, 30 * id, to_timestamp('{day} 03:00:00 +00:00'))" if kind == "timestamp"
              else f"cast('{day} 00:00:00' as timestamp_ntz) + make_dt_interval(0, 0, 30 * id)")
        rows = spark.range(24).selectExpr("id", f"{at} AS at")
        seen, mark = [], None
        for upto in (6, 9, 10, 24):
            batch, mark = incremental(rows.where(f"id < {upto}"), "at", mark)
            seen.append(sorted(r.id for r in batch.collect()))
        assert seen == [list(range(6)), [6, 7, 8], [9], list(range(10, 24))]
        lo, hi = slices.exact_row(rows, F.min("at"), F.max("at"))
        number = slices.range_slice_number(F.col("at"), lo, hi, 3, rows.schema["at"].dataType)
        got = [r.n for r in rows.orderBy("id").select(number.alias("n")).collect()]
        assert got == [0] * 8 + [1] * 8 + [2] * 8
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        monkeypatch.undo()
        time.tzset()


def test_rows_without_a_mark_are_in_the_first_batch(spark):
    rows = spark.sql("select * from values (1, 10), (2, null), (3, 20) t(id, `a.b`)")
    first, mark = incremental(rows, "a.b")
    assert sorted(r.id for r in first.collect()) == [1, 2, 3] and mark == 20
    second, same = incremental(rows, "a.b", mark)
    assert second.collect() == [] and same == 20
    assert [r.id for r in incremental(rows.where("id = 2"), "a.b")[0].collect()] == [2]
