"""Slices of equal size, and ranges of text."""

import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators import slices

chars = st.characters(exclude_categories=["Cs"])


@pytest.fixture
def ansi_names(spark):
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    yield
    spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")


@pytest.fixture
def skewed(spark):
    """30,000 rows: a third have one key, the others are cubes, some are NULL."""
    return spark.range(30_000).selectExpr(
        "id", "-id AS other", "CASE WHEN id % 3 = 0 THEN 1000 WHEN id % 1000 = 1 THEN NULL ELSE id * id * id END AS k")


def sizes(df, number):
    return [r["count"] for r in df.groupBy(number.alias("s")).count().orderBy("s").collect()]


@pytest.mark.parametrize("n", [2, 7, 32])
def test_slices_of_equal_size(skewed, n):
    cuts = slices.quantile_cuts(skewed, "k", n)
    assert cuts == sorted(cuts) and len(cuts) == n - 1
    got = sizes(skewed, slices.quantile_slice_number(skewed, "k", cuts, ["id"]))
    assert len(got) == n and sum(got) == 30_000 and max(got) < 2 * 30_000 / n


def test_a_hot_key_stays_together_without_other_columns(skewed):
    cuts = slices.quantile_cuts(skewed, "k", 16)
    number = slices.quantile_slice_number(skewed, "k", cuts)
    assert skewed.where("k = 1000").select(number).distinct().count() == 1
    assert sum(sizes(skewed, number)) == 30_000


@pytest.mark.parametrize("spread", [None, "other"])
def test_quantile_predicates_partition_the_table(skewed, ansi_names, spread):
    cuts = slices.quantile_cuts(skewed, "k", 12)
    predicates = slices.quantile_predicates("k", cuts, spread)
    matched = skewed.select(sum(F.expr(f"CAST(coalesce({p}, false) AS INT)") for p in predicates).alias("m"))
    assert [r.m for r in matched.distinct().collect()] == [1]
    if spread:
        assert len(predicates) == 12
        assert max(skewed.where(p).count() for p in predicates) < 2 * 30_000 / 12


@pytest.mark.parametrize("expression", [
    "CAST(id * id AS DECIMAL(20,2))", "date_add(DATE'2020-01-01', CAST(id % 700 AS INT))",
    "timestamp_micros(id * id * id)", "TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * id)",
    "id * 0.5D"])
def test_kinds_of_split_columns(spark, expression):
    df = spark.range(5_000).withColumn("k", F.expr(expression))
    cuts = slices.quantile_cuts(df, "k", 10)
    got = sizes(df, slices.quantile_slice_number(df, "k", cuts))
    assert sum(got) == 5_000 and max(got) < 1_000
    assert slices.quantile_predicates("k", cuts)


def test_quantiles_of_odd_tables(spark):
    empty = spark.createDataFrame([], "k int")
    assert slices.quantile_cuts(empty, "k", 4) == []
    nulls = spark.createDataFrame([(None,), (None,)], "k int")
    assert sizes(nulls, slices.quantile_slice_number(nulls, "k", slices.quantile_cuts(nulls, "k", 4))) == [2]
    assert slices.quantile_predicates("k", []) == ["1=1"] and slices.quantile_cuts(nulls, "k", 1) == []
    with pytest.raises(ValueError, match="quantiles"):
        slices.quantile_cuts(spark.createDataFrame([("a",)], "k string"), "k", 4)


# --------------------------------------------------------------------- text

@given(st.text(chars, max_size=8), st.text(chars, max_size=8))
def test_text_numbers_keep_the_order_of_bytes(a, b):
    a, b = a.rstrip("\0"), b.rstrip("\0")
    by_number = (slices.text_number(a) > slices.text_number(b)) - (slices.text_number(a) < slices.text_number(b))
    by_bytes = (a.encode() > b.encode()) - (a.encode() < b.encode())
    assert by_number == by_bytes
    assert slices.number_text(slices.text_number(a)) == a


@given(st.lists(st.text(chars, max_size=12), min_size=2, max_size=2), st.integers(1, 20))
def test_text_cuts_lie_in_order_between_the_bounds(pair, n):
    lo, hi = sorted(pair)
    cuts = slices.range_cuts(lo, hi, n)
    assert cuts[0] == lo and len(cuts) <= n
    assert all(a < b for a, b in zip(cuts, cuts[1:])) and all(c <= hi for c in cuts)


def test_text_cuts_spread_names():
    cuts = slices.text_cuts("part-a", "part-z", 5)
    assert len(cuts) == 5 and all(len(c) < 9 for c in cuts)


NAMES = ["", "a", "ab", "abc", "b", "it's", "é", "日本", "z" * 20, "zz", "\U0001F600", None]


@pytest.mark.parametrize("n", [1, 3, 8])
def test_ranges_of_text_partition_the_table(spark, ansi_names, n):
    df = spark.createDataFrame([(i, name) for i, name in enumerate(NAMES * 3)], "id int, name string")
    lo, hi = slices.bounds(df, "name").first()
    predicates = slices.range_predicates("name", lo, hi, n, binary_text=True)
    matched = df.select(sum(F.expr(f"CAST(coalesce({p}, false) AS INT)") for p in predicates).alias("m"))
    assert {r.m for r in matched.collect()} == {1}
    number = slices.range_slice_number(F.col("name"), lo, hi, n, df.schema["name"].dataType)
    for i, p in enumerate(predicates):
        assert sorted(r.id for r in df.where(p).collect()) == sorted(r.id for r in df.where(number == i).collect())


def test_guards_of_text_ranges(spark):
    with pytest.raises(ValueError, match="bytes"):
        slices.range_predicates("name", "a", "b", 3)
    folded = spark.createDataFrame([("a",)], "name string").select(F.col("name").cast(T.StringType("UTF8_LCASE")))
    with pytest.raises(ValueError, match="collation"):
        slices.range_slice_number(F.col("name"), "a", "b", 3, folded.schema["name"].dataType)
    assert slices.range_cuts(None, None, 3) == [None]
    assert slices.range_cuts(datetime.date(2020, 1, 1), datetime.date(2020, 1, 3), 2)[1] == datetime.date(2020, 1, 2)
