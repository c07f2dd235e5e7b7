"""Batches with late rows: nothing lost within the look-back, nothing twice."""

import datetime

import pytest

from ferryline import TransferError
from ferryline.streaming.late import late_batch


def run(spark, df, ledger, look_back=10, col="at", keys=("id",), commit=True):
    batch = late_batch(df, col, list(keys), ledger, look_back)
    rows = sorted(r.id for r in batch.rows.collect())
    if commit:
        batch.commit()
    return rows, batch.mark


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, at int")


def test_late_rows_come_once(spark, new_dir):
    ledger, rows = new_dir("ledger"), [(1, 5), (2, 20), (3, 30), (4, None)]
    assert run(spark, frame(spark, rows), ledger) == ([1, 2, 3, 4], 30)
    assert run(spark, frame(spark, rows), ledger) == ([], 30)
    rows += [(5, 25), (6, 21), (7, 15), (8, 40), (9, None)]  # 7 is beyond the look-back, 9 has no value
    assert run(spark, frame(spark, rows), ledger) == ([5, 6, 8], 40)
    rows += [(10, 39), (11, 40), (12, 22)]
    assert run(spark, frame(spark, rows), ledger) == ([10, 11], 40)
    assert run(spark, frame(spark, rows), ledger) == ([], 40)


def test_a_run_that_broke_off_is_repeated(spark, new_dir):
    ledger, df = new_dir("ledger"), frame(spark, [(1, 5), (2, 20)])
    assert run(spark, df, ledger, commit=False) == ([1, 2], 20)
    assert run(spark, df, ledger) == ([1, 2], 20)
    assert run(spark, df, ledger) == ([], 20)


def test_of_two_runs_one_commits(spark, new_dir):
    ledger, df = new_dir("ledger"), frame(spark, [(1, 5), (2, 20)])
    one, two = (late_batch(df, "at", ["id"], ledger, 10) for _ in range(2))
    one.commit()
    with pytest.raises(TransferError, match="another run"):
        two.commit()
    assert run(spark, df, ledger) == ([], 20)


def test_times_and_keys_of_several_columns(spark, new_dir):
    ledger, day = new_dir("ledger"), datetime.timedelta(days=1)
    at = datetime.datetime(2024, 1, 1)
    schema = "id int, part string, at timestamp_ntz"
    rows = [(1, "a", at), (1, None, at + day), (2, "b", at + day)]
    kw = {"look_back": 2 * day, "keys": ("id", "part")}
    assert run(spark, spark.createDataFrame(rows, schema), ledger, **kw) == ([1, 1, 2], at + day)
    rows += [(1, "b", at), (1, None, at + day), (2, None, at + day)]
    assert run(spark, spark.createDataFrame(rows, schema), ledger, **kw) == ([1, 2], at + day)


def test_empty_and_null_only(spark, new_dir):
    ledger = new_dir("ledger")
    assert run(spark, frame(spark, []), ledger) == ([], None)
    assert run(spark, frame(spark, [(1, 3)]), ledger) == ([1], 3)
    other = new_dir("ledger")
    assert run(spark, frame(spark, [(1, None)]), other) == ([1], None)
    assert run(spark, frame(spark, [(1, None), (2, 7), (3, None)]), other) == ([2], 7)
    assert run(spark, frame(spark, [(1, None), (2, 7)]), other) == ([], 7)


def test_the_ledger_holds_the_look_back_only(spark, new_dir):
    ledger = new_dir("ledger")
    for upto in (1000, 2000, 3000):
        run(spark, spark.range(upto).selectExpr("CAST(id AS INT) AS id", "CAST(id AS INT) AS at"), ledger)
    newest = spark.read.parquet(f"{ledger}/state-0000000002")
    assert newest.count() == 10 and newest.selectExpr("min(_value)").first()[0] == 2990
