"""Whole transfers on files and catalog tables."""

import json
import os
from decimal import Decimal
from glob import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline import (
    Directory, LoadOptions, NotATableError, RejectBudgetExceeded, Table, UnloadOptions,
    export_dir, import_rows, load, load_records, unload, unload_table,
)


def lines_in(spark, path, **kw):
    return sorted(r["value"] for r in spark.read.text(path, **kw).collect())


def write_lines(path, lines):
    os.makedirs(path)
    with open(f"{path}/part-0.txt", "w", encoding="utf-8") as f:
        f.write("".join(line + "\n" for line in lines))
    return path


@pytest.fixture
def table(spark):
    made = []

    def make(columns):
        name = f"t_{len(made)}_{os.urandom(4).hex()}"
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet")
        made.append(name)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP TABLE {name}")


# ------------------------------------------------------------------ unload

def test_unload_two_partitions(spark, new_dir):
    df = spark.createDataFrame([(1, "foo"), (2, "bar"), (3, "baz"), (4, "biff")], "a int, b string")
    path = new_dir()
    summary = unload(df.repartition(2), path)
    assert lines_in(spark, path) == ["1,foo", "2,bar", "3,baz", "4,biff"]
    assert len(glob(f"{path}/part-*")) == 2 and os.path.exists(f"{path}/_SUCCESS")
    assert (summary["rows_read"], summary["rows_loaded"], summary["rows_rejected"]) == (4, 4, 0)


def test_success_mark_waits_for_the_budget(spark, new_dir, monkeypatch):
    import ferryline.plans.unload as plan

    marked = []
    monkeypatch.setattr(plan, "touch", lambda spark, mark: marked.append(mark))
    path = new_dir()
    unload(spark.range(3).withColumn("s", F.lit("x")), path)
    assert marked == [f"{path}/_SUCCESS"]
    assert glob(f"{path}/part-*") and not os.path.exists(f"{path}/_SUCCESS")


def test_unload_of_nothing(spark, new_dir):
    df = spark.createDataFrame([], "a int, b string")
    assert unload(df, new_dir())["rows_read"] == 0
    assert unload(spark.range(5).where("id > 9").withColumn("s", F.lit("x")), new_dir())["rows_read"] == 0


def test_unload_budget(spark, new_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b\nb"), (3, "c")], "a int, b string")
    path, shared = new_dir(), new_dir("rejects")
    with pytest.raises(RejectBudgetExceeded) as failed:
        unload(df, path, UnloadOptions(rejects_path=shared))
    assert not os.path.exists(path)
    assert failed.value.summary["by_reason"] == {"line_end": 1}
    path = new_dir()
    summary = unload(df, path, UnloadOptions(max_errors=2, rejects_path=shared))
    assert lines_in(spark, path) == ["1,a", "3,c"]
    assert summary["rows_rejected"] == 1
    rejects = spark.read.json(f"{shared}/rejects").collect()
    assert [(r["column"], r["reason"]) for r in rejects] == [("b", "line_end")] * 2
    assert spark.read.json(f"{shared}/summary").count() == 2


def test_stored_unload_rejects_are_the_counted_ones(spark, new_dir):
    """An unstable frame: every read of it gives other rows."""
    from ferryline.shared import shared_dir

    unstable = spark.range(2000).select("id", F.when(F.rand() < 0.5, F.lit("a\n")).otherwise(F.lit("a")).alias("s"))
    path, shared = new_dir(), new_dir("rejects")
    stages = set(glob(f"{shared_dir(spark)}/unload-*"))
    summary = unload(unstable, path, UnloadOptions(max_errors=5000, rejects_path=shared))
    assert spark.read.json(f"{shared}/rejects").count() == summary["rows_rejected"]
    assert len(lines_in(spark, path)) == summary["rows_loaded"] == 2000 - summary["rows_rejected"]
    assert set(glob(f"{shared_dir(spark)}/unload-*")) == stages


def test_unload_keeps_line_ends_when_escaped(spark, new_dir):
    df = spark.createDataFrame([(1, "a\r\nb\n"), (2, "\n")], "a int, b string")
    path, target = new_dir(), new_dir("target")
    unload(df, path, UnloadOptions(newline_policy="escape", record_sep="\x1e"))
    load(spark, path, Directory(target), LoadOptions(record_sep="\x1e"), schema=df.schema)
    assert sorted(spark.read.parquet(target).collect()) == sorted(df.collect())


def test_unload_is_one_stage(spark, new_dir):
    from ferryline.operators.encode import encode

    path = new_dir("src")
    spark.range(100).selectExpr("id", "cast(id as string) s", "id * 2 as unused").write.parquet(path)
    plan = encode(spark.read.parquet(path), columns=["id", "s"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "unused" not in plan.split("ReadSchema")[1]


def test_unload_checks_the_object_type(spark, table, new_dir):
    name = table("a int, b string")
    spark.sql(f"INSERT INTO {name} VALUES (1, 'x,y'), (2, null)")
    path = new_dir()
    unload_table(spark, Table(name, columns=("b", "a"), where="a < 9 OR a IS NULL"), path)
    assert lines_in(spark, path) == ["null,2", "x\\,y,1"]
    spark.table(name).createOrReplaceTempView("some_view")
    with pytest.raises(NotATableError, match="real tables"):
        unload_table(spark, Table("some_view"), new_dir())
    with pytest.raises(NotATableError, match="check the schema"):
        unload_table(spark, Table("missing_table"), new_dir())
    with pytest.raises(ValueError, match="free-form"):
        unload_table(spark, Table(name), new_dir(), query="select 1")
    with pytest.raises(ValueError, match="parquet"):
        unload_table(spark, Table(name), new_dir(), layout="parquet")


def test_tables_of_another_schema(spark, table, new_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS other_schema")
    spark.sql("CREATE TABLE other_schema.same USING parquet AS SELECT 1 a, 'in other' b")
    spark.sql("SELECT 2 a, 'view' b").createOrReplaceTempView("same")
    path = new_dir()
    unload_table(spark, Table("same", schema="other_schema"), path)
    assert lines_in(spark, path) == ["1,in other"]
    spark.sql("DROP TABLE other_schema.same")


# -------------------------------------------------------------------- load

@pytest.mark.parametrize(
    "ddl,line,opts,expected",
    [
        ("int", "1,42", {}, 42),
        ("int", "1,null", {}, None),
        ("string", "1,bl\\,eh", {}, "bl,eh"),
        ("decimal(12,4)", "1|3.1416", {"field_delim": "|", "max_errors": 2}, Decimal("3.1416")),
        ("varchar(8)", "1|this string is too long", {"field_delim": "|"}, "this str"),
        ("varchar(32)", "1|\\N", {"field_delim": "|", "null_string": "\\\\N"}, None),
        ("varchar(64)", "1,a\tb\bc", {"ctrl_chars": True}, "a\tb\bc"),
        ("varchar(64)", "1,žluťoučký kůň", {}, "žluťoučký kůň"),
        ("char(3)", "1,b", {}, "b  "),
        ("boolean", "1,true", {}, True),
    ],
)
def test_load_into_a_catalog_table(spark, table, new_dir, ddl, line, opts, expected):
    name = table(f"id int, val {ddl}")
    path = write_lines(new_dir("in"), [line])
    summary = load(spark, path, Table(name), LoadOptions(**opts))
    assert summary["rows_loaded"] == 1
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, expected)]


def test_load_rejects_within_the_budget(spark, table, new_dir):
    name, shared = table("id int, val int"), new_dir("rejects")
    path = write_lines(new_dir("in"), ["1|twenty", "2|20"])
    opts = LoadOptions(field_delim="|", max_errors=2, rejects_path=shared)
    summary = load(spark, path, Table(name), opts)
    assert (summary["rows_read"], summary["rows_loaded"], summary["rows_rejected"]) == (2, 1, 1)
    assert spark.table(name).collect() == [(2, 20)]
    rejects = spark.read.json(f"{shared}/rejects").collect()
    assert [(r["raw"], r["column"], r["reason"]) for r in rejects] == [("1|twenty", "val", "invalid_integer")]
    logs = glob(f"{shared}/summary/*/*.json")
    assert len(logs) == 1
    with open(logs[0], encoding="utf-8") as f:
        assert json.load(f)["by_reason"] == {"invalid_integer": 1}


def test_load_over_the_budget_publishes_nothing(spark, table, new_dir):
    name, shared = table("id int, val int"), new_dir("rejects")
    path = write_lines(new_dir("in"), ["1,x", "2,20", "3,y"])
    for budget, fails in ((1, True), (2, True), (3, False)):
        opts = LoadOptions(max_errors=budget, rejects_path=shared)
        if fails:
            with pytest.raises(RejectBudgetExceeded) as failed:
                load(spark, path, Table(name), opts)
            assert failed.value.summary["rows_rejected"] == 2
            assert spark.table(name).count() == 0
        else:
            load(spark, path, Table(name), opts)
            assert spark.table(name).count() == 1
    assert spark.read.json(f"{shared}/summary").count() == 3


def test_clean_load_reads_its_input_once(spark, table, new_dir, monkeypatch):
    import ferryline.plans.load as plan

    monkeypatch.setattr(plan, "stage", None)
    name, shared = table("id int, val string"), new_dir("rejects")
    path = write_lines(new_dir("in"), [f"{i},x" for i in range(100)])
    summary = load(spark, path, Table(name), LoadOptions(rejects_path=shared))
    assert (summary["rows_read"], summary["rows_loaded"]) == (100, 100)
    assert spark.table(name).count() == 100
    assert spark.read.json(f"{shared}/summary").first()["rows_read"] == 100
    empty = load(spark, write_lines(new_dir("in"), []), Table(name))
    assert empty["rows_read"] == 0


def test_failed_load_leaves_no_files(spark, new_dir):
    path, target = write_lines(new_dir("in"), ["1", "2", "x"]), new_dir("target")
    with pytest.raises(RejectBudgetExceeded):
        load(spark, path, Directory(target), schema=T.StructType.fromDDL("a int"))
    assert not glob(f"{target}/**/*.parquet", recursive=True)


def test_load_removes_its_stage(spark, new_dir):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.exists(shared) else set()
    path = write_lines(new_dir("in"), ["1"])
    opts = LoadOptions(max_errors=2)
    load(spark, path, Directory(new_dir()), opts, schema=T.StructType.fromDDL("a int"))
    assert set(os.listdir(shared)) == before


def test_load_binds_by_position(spark, table, new_dir):
    name = table("b string, a int")
    path = write_lines(new_dir("in"), ["x,1", ",2"])
    load(spark, path, Table(name))
    assert sorted(map(tuple, spark.table(name).collect())) == [("", 2), ("x", 1)]
    with pytest.raises(ValueError, match="columns"):
        load(spark, path, Table(name), schema=T.StructType.fromDDL("a int"))
    with pytest.raises(ValueError, match="update"):
        load(spark, path, Table(name), mode="update")
    with pytest.raises(ValueError, match="needs a schema"):
        load(spark, path, Directory(new_dir()))


def test_load_refuses_views_and_layouts(spark, new_dir):
    spark.sql("select 1 a").createOrReplaceTempView("a_view")
    path = write_lines(new_dir("in"), ["1"])
    with pytest.raises(NotATableError):
        load(spark, path, Table("a_view"))
    for layout in ("sequencefile", "avro", "parquet"):
        with pytest.raises(ValueError, match=layout):
            load(spark, path, Table("a_view"), layout=layout)


def test_record_load_uses_the_configured_delimiter(spark, table, new_dir):
    name, path = table("id int, val varchar(5), ok boolean"), new_dir("records")
    spark.createDataFrame(
        [(1, "a|b,c\nd", True), (2, None, None), (3, "\x1e\\", False)],
        "id int, val string, ok boolean",
    ).write.orc(path)
    summary = load_records(
        spark, path, Table(name), LoadOptions(field_delim="|", ctrl_chars=True), fmt="orc"
    )
    assert summary["rows_rejected"] == 0
    got = sorted(map(tuple, spark.table(name).collect()))
    assert got == [(1, "a|b,c", True), (2, None, None), (3, "\x1e\\", False)]


def test_wide_rows(spark, new_dir):
    width = 60
    df = spark.range(20).select(*[(F.col("id") * k).alias(f"c{k}") for k in range(width)])
    path, target = new_dir(), new_dir("target")
    unload(df, path)
    load(spark, path, Directory(target), schema=df.schema)
    assert sorted(spark.read.parquet(target).collect()) == sorted(df.collect())


def test_generated_methods_stay_compilable(spark, new_dir):
    import re

    from ferryline import decode

    schema = T.StructType.fromDDL(", ".join(
        f"c{k} {t}" for k, t in enumerate(["decimal(18,4)", "bigint", "string", "timestamp_ntz"] * 10)
    ))
    path = write_lines(new_dir("in"), ["x"])
    df = decode(spark.read.text(path), schema)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


# ------------------------------------------------------------ non-direct mode

def test_import_of_views_and_queries(spark, new_dir):
    df = spark.sql("select 1 a, cast(null as int) b, cast(null as string) c")
    path = new_dir()
    import_rows(df, path)
    assert lines_in(spark, path) == ["1,null,null"]
    for fmt in ("parquet", "orc"):
        path = new_dir()
        import_rows(df, path, fmt)
        assert spark.read.format(fmt).load(path).collect() == df.collect()
    with pytest.raises(ValueError, match="format"):
        import_rows(df, new_dir(), "avro")


def test_export_of_text_and_records(spark, table, new_dir):
    name = table("id int, val string")
    export_dir(spark, write_lines(new_dir("in"), ["1,null", "null,b"]), Table(name))
    records = new_dir("records")
    spark.createDataFrame([(7, "z")], "x int, y string").write.parquet(records)
    export_dir(spark, records, Table(name), "parquet")
    assert sorted(map(str, spark.table(name).collect())) == sorted(
        map(str, [T.Row(id=1, val=None), T.Row(id=None, val="b"), T.Row(id=7, val="z")])
    )
    with pytest.raises(ValueError, match="warehouse table"):
        export_dir(spark, records, Table(name), "parquet", update_keys=["id"])
