"""Statements, options and partitions of the JDBC paths.

No database is started: the calls that would reach one are recorded, and the
predicates themselves are checked on data in ``test_slices``.
"""

import datetime

import pytest

from ferryline import (
    Connection, NotATableError, Table, export_dir, load, read_query, read_table, unload_table,
)
from ferryline.sinks import jdbc as sink
from ferryline.sources import jdbc as source

CONN = Connection("jdbc:wh://host/db", driver="x.Driver", user="u", password="p",
                  options={"fetchsize": "10000"})


class Warehouse:
    """Records reads and writes; answers queries with prepared DataFrames."""

    def __init__(self, spark):
        self.spark, self.answers = spark, []
        self.queries, self.reads, self.saved, self.executed = [], [], [], []
        self.table = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, val string")

    def load(self, spark, options):
        self.queries.append(options)
        for part, answer in self.answers:
            if part in options["query"]:
                return answer
        return self.table

    def read(self, spark, options, predicates):
        self.reads.append((options, predicates))
        return self.table

    def save(self, rows, options):
        self.saved.append((sorted(map(tuple, rows.collect())), rows.columns, options))

    def execute(self, spark, connection, statements):
        self.executed += statements


@pytest.fixture
def warehouse(spark, monkeypatch):
    w = Warehouse(spark)
    w.answers.append(("INFORMATION_SCHEMA", spark.sql("select 'BASE TABLE' as t")))
    monkeypatch.setattr(source, "_load", w.load)
    monkeypatch.setattr(source, "_read_predicates", w.read)
    monkeypatch.setattr(sink, "_save", w.save)
    monkeypatch.setattr(sink, "execute", w.execute)
    return w


def test_sliced_read(spark, warehouse):
    df = read_table(spark, CONN, 'my"t', schema="S", columns=["val", "id"],
                    where="a = 1 OR b = 2", slice_key="id", num_slices=3)
    options, predicates = warehouse.reads[0]
    assert options == {**CONN.properties(), "dbtable": '"S"."my""t"'}
    assert predicates == [
        f'COALESCE(ABS(MOD("id", 3)), 0) = {i} AND ( a = 1 OR b = 2 )' for i in range(3)
    ]
    assert df.columns == ["val", "id"]


def test_single_task_and_system_slices(spark, warehouse):
    read_table(spark, CONN, "t")
    read_table(spark, CONN, "t", where="x > 0", num_slices=1, slice_key="id")
    read_table(spark, CONN, "t", slice_key="SLICE_ID", num_slices=2, slicing="system")
    assert [p for _, p in warehouse.reads] == [
        ["1=1"], ["1=1 AND ( x > 0 )"],
        ["MOD(SLICE_ID, 2) = 0", "MOD(SLICE_ID, 2) = 1"],
    ]
    with pytest.raises(ValueError, match="slicing"):
        read_table(spark, CONN, "t", slice_key="id", num_slices=2, slicing="random")


def test_range_slices_fetch_their_bounds_once(spark, warehouse):
    lo, hi = datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 3)
    warehouse.answers.append(("MIN", spark.createDataFrame([(lo, hi)], "lo timestamp_ntz, hi timestamp_ntz")))
    read_table(spark, CONN, "t", where="x > 0", slice_key="At", num_slices=2, slicing="range")
    assert [q["query"] for q in warehouse.queries] == [
        'SELECT MIN("At") AS lo, MAX("At") AS hi FROM "t" WHERE ( x > 0 )'
    ]
    assert warehouse.reads[0][1] == [
        "(\"At\" < TIMESTAMP '2020-01-02 00:00:00' OR \"At\" IS NULL) AND ( x > 0 )",
        "\"At\" >= TIMESTAMP '2020-01-02 00:00:00' AND ( x > 0 )",
    ]


def test_query_reads(spark, warehouse):
    read_query(spark, CONN, "select 1 as k")
    assert warehouse.queries[0]["query"] == "select 1 as k"
    warehouse.answers.append(("MIN", spark.sql("select 0 lo, 10 hi")))
    read_query(spark, CONN, "select k from t", split_by="k", num_slices=2)
    options, predicates = warehouse.reads[0]
    assert options["dbtable"] == "(select k from t) q"
    assert predicates == ['("k" < 5 OR "k" IS NULL)', '"k" >= 5']
    with pytest.raises(ValueError, match="split column"):
        read_query(spark, CONN, "select 1", num_slices=2)


def test_boolean_split_columns(spark, warehouse):
    warehouse.answers.append(("MIN", spark.sql("select false lo, true hi")))
    with pytest.raises(ValueError, match="boolean"):
        read_query(spark, CONN, "select k from t", split_by="k", num_slices=2)


def test_object_type_lookup(spark, warehouse):
    assert source.object_type(spark, CONN, "it's") == "BASE TABLE"
    assert source.object_type(spark, CONN, "t", "S") == "BASE TABLE"
    assert [q["query"].split("WHERE ")[1] for q in warehouse.queries] == [
        "TABLE_NAME = 'it''s' AND TABLE_SCHEMA = CURRENT_SCHEMA",
        "TABLE_NAME = 't' AND TABLE_SCHEMA = 'S'",
    ]
    warehouse.answers.insert(0, ("'gone'", spark.sql("select 'x' t where false")))
    with pytest.raises(NotATableError, match="letter case"):
        source.object_type(spark, CONN, "gone")


def test_unload_of_a_warehouse_table(spark, warehouse, tmp_path):
    path = str(tmp_path / "out")
    unload_table(spark, Table("t", connection=CONN, slice_key="id", num_slices=2), path)
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ["1,a\\,b", "2,null"]
    warehouse.answers.insert(0, ("'v'", spark.sql("select 'VIEW' t")))
    with pytest.raises(NotATableError, match="real tables"):
        unload_table(spark, Table("v", schema="S", connection=CONN), path + "2")


def test_load_into_a_warehouse_table(spark, warehouse, tmp_path):
    (tmp_path / "in.txt").write_text("1,a\n2,b\n", encoding="utf-8")
    load(spark, str(tmp_path / "in.txt"), Table("t", schema="S", connection=CONN))
    (rows, columns, options), = warehouse.saved
    assert columns == ["id", "val", sink.ROW_NUMBER]
    assert [r[:2] for r in rows] == [(1, "a"), (2, "b")] and rows[0][2] != rows[1][2]
    assert options["isolationLevel"] == "READ_COMMITTED" and options["numPartitions"] == "32"
    staging = options["dbtable"]
    assert warehouse.executed == [
        f'CREATE TABLE {staging} AS SELECT "id", "val", CAST(0 AS BIGINT) AS "{sink.ROW_NUMBER}" '
        'FROM "S"."t" WHERE 1 = 0',
        f'INSERT INTO "S"."t" ("id", "val") SELECT "id", "val" FROM ({once(staging)}) s',
        f"DROP TABLE {staging}",
    ]


def once(staging):
    """The query that reads every staged row once, however often it was sent."""
    return (f'SELECT "id", "val" FROM (SELECT "id", "val", ROW_NUMBER() OVER (PARTITION BY '
            f'"{sink.ROW_NUMBER}" ORDER BY "{sink.ROW_NUMBER}") AS "{sink.COPY}" FROM {staging}) d '
            f'WHERE "{sink.COPY}" = 1')


def test_update_of_a_warehouse_table(spark, warehouse, tmp_path):
    path = str(tmp_path / "changes")
    spark.createDataFrame([(1, "x"), (3, "y")], "id int, val string").write.parquet(path)
    target = Table("t", connection=CONN)
    export_dir(spark, path, target, "parquet", update_keys=["id"])
    (rows, _, options), = warehouse.saved
    assert [r[:2] for r in rows] == [(1, "x"), (3, "y")]
    assert warehouse.executed[1] == (
        f'MERGE INTO "t" t USING ({once(options["dbtable"])}) s '
        'ON t."id" = s."id" WHEN MATCHED THEN UPDATE SET "val" = s."val"'
    )
    with pytest.raises(ValueError, match="exactly one writer"):
        export_dir(spark, path, target, "parquet", update_keys=["id"], num_writers=4)


def test_update_settings_reach_the_sink(spark, warehouse, tmp_path):
    path = str(tmp_path / "changes")
    spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "id int, val string, at int").write.parquet(path)
    export_dir(spark, path, Table("t", connection=CONN), "parquet", update_keys=["id"],
               order_by=["at"], max_connections=3, batch_size=50)
    (rows, columns, options), = warehouse.saved
    assert [r[:2] for r in rows] == [(1, "new")] and columns == ["id", "val", sink.ROW_NUMBER]
    assert (options["numPartitions"], options["batchsize"]) == ("3", "50")
    with pytest.raises(ValueError, match="order_by"):
        export_dir(spark, path, Table("t", connection=CONN), "parquet", order_by=["at"])


def test_staged_rows_are_read_once(spark):
    """The query over a staging table, run by Spark on rows that were sent twice."""
    spark.createDataFrame([(1, "a", 0), (1, "a", 1), (2, None, 2), (2, None, 2)],
                          f"id int, val string, {sink.ROW_NUMBER} bigint").createOrReplaceTempView("sent_twice")
    query = once("sent_twice").replace('"', "`")
    assert sorted(map(str, spark.sql(query).collect())) == [
        "Row(id=1, val='a')", "Row(id=1, val='a')", "Row(id=2, val=None)"]


def test_failed_statements_drop_the_staging_table(spark, warehouse, monkeypatch):
    calls = []

    def execute(spark, connection, statements):
        calls.extend(statements)
        if statements[0].startswith("INSERT"):
            raise RuntimeError("warehouse says no")

    monkeypatch.setattr(sink, "execute", execute)
    with pytest.raises(RuntimeError, match="says no"):
        sink.append_table(warehouse.table, CONN, "t")
    assert calls[-1].startswith("DROP TABLE")


def test_row_numbers_are_the_same_in_every_attempt(spark, tmp_path):
    from pyspark.sql import functions as F

    from ferryline.shared import materialize

    stored = materialize(spark.range(5000).repartition(7))
    numbered = stored.withColumn("n", F.monotonically_increasing_id())
    assert sorted(numbered.collect()) == sorted(numbered.collect())


def test_the_driver_side_calls_exist(spark):
    """Everything ``execute`` needs short of a database."""
    assert spark._jvm.java.sql.Connection.TRANSACTION_READ_COMMITTED == 2
    with pytest.raises(Exception, match="No suitable driver"):
        sink.execute(spark, Connection("jdbc:none:x", user="u", password="p"), ["SELECT 1"])
    with pytest.raises(Exception, match="no.such.Driver"):
        sink.execute(spark, Connection("jdbc:none:x", driver="no.such.Driver"), ["SELECT 1"])
