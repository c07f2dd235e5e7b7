"""The query ``rejects_by_file`` on a table of several files."""

import datetime
import os
import sys
from collections import Counter

import duckdb
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from workload import loading  # noqa: E402

ROWS, FILES = 4_000, 5


def write_lineitem(spark, sf_dir):
    """Rows of every kind of reject in both folders, dealt out over ``FILES`` files."""
    key = F.col("id")
    money = [(F.pmod(key, F.lit(n)) / 4).alias(f"l_{c}") for n, c in
             ((50, "quantity"), (997, "extendedprice"), (11, "discount"), (9, "tax"))]
    spark.range(0, ROWS, 1, FILES).select(
        key.alias("l_orderkey"), (key % 70).alias("l_partkey"), (key % 30).alias("l_suppkey"),
        F.pmod(key / 7, F.lit(8)).cast("int").alias("l_linenumber"), *money,
        F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.lit(datetime.datetime(1995, 3, 4, 5, 6, 7)).cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(f"{sf_dir}/lineitem.parquet")


def test_no_task_writes_a_whole_folder(spark, new_dir, monkeypatch):
    sf_dir, made = new_dir("tables"), {p: new_dir(p) for p in ("text", "target", "rejects")}
    write_lineitem(spark, sf_dir)
    assert loading.lineitem(spark, sf_dir).rdd.getNumPartitions() == FILES
    monkeypatch.setattr(loading, "new_path", lambda _, purpose: made[purpose])
    result = loading.rejects_by_file(spark, sf_dir).collect()

    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS FROM read_parquet('{sf_dir}/lineitem.parquet/*.parquet')")
    expected = con.sql(loading.LOAD_SQL["rejects_by_file"])
    assert expected.columns == list(result[0].asDict())
    assert sorted(map(tuple, result)) == sorted(expected.fetchall())
    assert {(r["folder"], r["reason"]) for r in result} == {
        (f, f"invalid_{t}") for f in ("first", "second") for t in ("integer", "decimal", "timestamp")}

    written = [(r[0], r[1]) for r in spark.read.text(f"{made['text']}/*").select(
        "_metadata.file_path", "value").collect()]
    assert len(written) == ROWS
    lines_of = Counter(file for file, _ in written)  # one task writes one file
    assert Counter(file.split("/")[-2] for file in lines_of) == {"first": FILES, "second": FILES}
    assert max(lines_of.values()) <= ROWS // FILES

    rejects = spark.read.json(f"{made['rejects']}/rejects").select("_source_file", "raw").collect()
    assert len(rejects) == sum(r["row_count"] for r in result)
    assert not Counter(map(tuple, rejects)) - Counter(written)  # each lies in the file that it names
