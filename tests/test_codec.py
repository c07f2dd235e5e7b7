"""The text form, both ways: fixtures, awkward text, and a brute-force model."""

import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline import LoadOptions, UnloadOptions, decode, encode, time_field


def lines_of(df, opts=None):
    return [r["value"] for r in encode(df, opts).collect()]


def decoded(spark, lines, ddl, opts=None):
    schema = ddl if isinstance(ddl, T.StructType) else T.StructType.fromDDL(ddl)
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return decode(df, schema, opts).collect()


def values(rows, name):
    return [r[name] for r in rows]


# ------------------------------------------------------------------ encode

def test_basic_rows(spark):
    df = spark.createDataFrame([(1, "meep"), (2, "beep")], "a int, b string")
    assert lines_of(df) == ["1,meep", "2,beep"]


@pytest.mark.parametrize(
    "delim,text,expected",
    [
        (",", "meep,beep", "1,meep\\,beep"),
        ("\t", "meep\tbeep", "1\tmeep\\\tbeep"),
        ("|", "a|b\\c", "1|a\\|b\\\\c"),
        (".", "a.b", "1.a\\.b"),
        (",", "žluťoučký kůň", "1,žluťoučký kůň"),
    ],
)
def test_escaping(spark, delim, text, expected):
    df = spark.createDataFrame([(1, text)], "a int, b string")
    assert lines_of(df, UnloadOptions(field_delim=delim)) == [expected]


def test_wrong_escape_is_coerced(spark):
    df = spark.createDataFrame([(1, "meep,beep")], "a int, b string")
    with pytest.warns(UserWarning):
        opts = UnloadOptions(escape="X")
    assert lines_of(df, opts) == ["1,meep\\,beep"]


def test_null_substitution(spark):
    df = spark.createDataFrame(
        [(1, None, None, "value")], "a int, b string, c int, d string"
    )
    assert lines_of(df, UnloadOptions(null_string="\\\\N")) == ["1,\\N,,value"]
    assert lines_of(df) == ["1,null,,value"]


def test_typed_text(spark):
    df = spark.sql(
        """select true b1, false b2, cast(null as boolean) b3,
           cast(12345678965341.627331 as decimal(30,8)) d, cast(1 as decimal(10,5)) e,
           date'2020-02-03' day, timestamp_ntz'2020-02-03 04:05:00' t0,
           timestamp_ntz'2020-02-03 04:05:06.120' t1"""
    )
    assert lines_of(df) == [
        "T,F,,12345678965341.62733100,1.00000,2020-02-03,2020-02-03 04:05:00,"
        "2020-02-03 04:05:06.12"
    ]
    assert lines_of(df, UnloadOptions(bool_style="TRUE_FALSE"))[0].startswith("TRUE,FALSE,,")


def test_char_padding_and_time(spark):
    df = spark.sql("select 'ab' c, timestamp_ntz'1970-01-01 04:05:06' t")
    opts = UnloadOptions(char_widths={"c": 4}, time_columns=("t",))
    assert lines_of(df, opts) == ["ab  ,04:05:06"]


@pytest.mark.parametrize("delim", ["-", ":", "1", "e", "T"])
def test_delimiter_inside_typed_text_is_escaped(spark, delim):
    df = spark.sql("select -11 a, true b, timestamp_ntz'2011-01-01 11:11:11' c, 1.5e20d d")
    line = lines_of(df, UnloadOptions(field_delim=delim))[0]
    back = decoded(
        spark, [line], "a int, b boolean, c timestamp_ntz, d double",
        LoadOptions(field_delim=delim, bool_style="T_F"),
    )[0]
    assert (back.a, back.b, back.d, back._reject_reason) == (-11, True, 1.5e20, None)


def test_unload_rejects(spark):
    df = spark.createDataFrame(
        [("ok",), ("a\nb",), ("a\rb",), ("a\bb",), (None,)], "a string"
    )
    assert values(encode(df).collect(), "_reject_reason") == [
        None, "line_end", "line_end", "control_character", None
    ]
    spaced = encode(df, UnloadOptions(newline_policy="space", ctrl_chars=True)).collect()
    assert values(spaced, "value") == ["ok", "a b", "a b", "a\bb", "null"]
    assert values(spaced, "_reject_reason") == [None] * 5
    kept = encode(df, UnloadOptions(newline_policy="escape", record_sep="\x1e")).collect()
    assert values(kept, "value")[1:3] == ["a\\\nb", "a\\\rb"]


@pytest.mark.parametrize("ddl", ["array<int>", "map<string,int>", "struct<x:int>", "binary"])
def test_types_without_text_form(spark, ddl):
    df = spark.createDataFrame([], f"a {ddl}")
    with pytest.raises(ValueError, match="no delimited text form"):
        encode(df)


# ------------------------------------------------------------------ decode

def test_decode_fixtures(spark):
    assert decoded(spark, ["1,42"], "id int, val int")[0].val == 42
    row = decoded(spark, ["1,null"], "id int, val int")[0]
    assert row.val is None and row._reject_reason is None
    assert decoded(spark, ["1,bl\\,eh"], "id int, val string")[0].val == "bl,eh"
    pipe = LoadOptions(field_delim="|")
    assert decoded(spark, ["1|3.1416"], "id int, val decimal(12,4)", pipe)[0].val == Decimal("3.1416")
    assert decoded(spark, ["1|this string is too long"], "id int, val varchar(8)", pipe)[0].val == "this str"
    assert decoded(spark, ["1,b"], "id int, val char(3)")[0].val == "b  "
    token = LoadOptions(field_delim="|", null_string="\\\\N")
    assert decoded(spark, ["1|\\N"], "id int, val string", token)[0].val is None
    ctrl = LoadOptions(ctrl_chars=True)
    assert decoded(spark, ["1,a\tb\bc"], "id int, val string", ctrl)[0].val == "a\tb\bc"


def test_decode_temporal(spark):
    schema = T.StructType.fromDDL("d date, ts timestamp_ntz").add(time_field("t"))
    row = decoded(spark, ["2020-02-03,2020-02-03 04:05:06.120,23:59:59"], schema)[0]
    assert row.d == datetime.date(2020, 2, 3)
    assert row.ts == datetime.datetime(2020, 2, 3, 4, 5, 6, 120000)
    assert row.t == "23:59:59" and row._reject_reason is None


@pytest.mark.parametrize(
    "ddl,good,bad",
    [
        ("int", ["0", "+7", "-7", "007", "2147483647"], [" 7", "7 ", "\t7", "7.0", "1e3", "2147483648", "twenty", "-"]),
        ("tinyint", ["127", "-128"], ["128"]),
        ("bigint", ["9223372036854775807"], ["9223372036854775808"]),
        ("decimal(8,4)", ["3.1416", "3", "3.", ".5", "-0.1000", "+1.50000"], ["3.14159", "1e2", " 1", "10000", ".", "", "abc"]),
        ("double", ["1.5", "1E20", "-.5"], ["1.5d", "0x1p3", "one"]),
        ("date", ["2020-02-29"], ["2020-2-9", "2020", "2021-02-29", "2020-02-29 ", "20200229"]),
        ("timestamp_ntz", ["2020-01-01 00:00:00", "2020-01-01 00:00:00.5", "2020-01-01 00:00:00.500"],
         ["2020-01-01", "2020-01-01T00:00:00", "2020-01-01 00:00", "2020-01-01 25:00:00", "2020-01-01 00:00:00.1234567"]),
        ("boolean", ["TRUE", "false", "True"], ["T", "1", "yes", "TRUE "]),
    ],
)
def test_strict_parsing(spark, ddl, good, bad):
    opts = LoadOptions(ctrl_chars=True, null_non_string="~")
    rows = decoded(spark, [f"{x}," for x in good + bad], f"v {ddl}, s string", opts)
    assert [r._reject_reason is None for r in rows] == [True] * len(good) + [False] * len(bad)
    assert all(r.v is not None for r in rows[: len(good)])
    assert all(r._reject_column == "v" for r in rows[len(good):])


def test_first_failing_rule(spark):
    schema = T.StructType(
        [T.StructField("a", T.IntegerType(), False), T.StructField("s", T.StringType())]
    )
    lines = ["1,x", "1", "1,x,y", "x,y", ",y", "null,y", "1,x\\", "1,x\\\\", "1,a\rb", "1,a\\\rb", "1,a\tb", ""]
    rows = decoded(spark, lines, schema)
    assert values(rows, "_reject_reason") == [
        None, "field_count", "field_count", "invalid_integer", "null_value", "null_value",
        "dangling_escape", None, "line_end", None, "control_character", "field_count",
    ]
    assert rows[3]._reject_column == "a" and rows[10]._reject_column == "s"
    assert rows[7].s == "x\\" and rows[9].s == "a\rb"
    assert values(rows, "_raw") == lines


def test_empty_fields(spark):
    row = decoded(spark, [",a,"], "x string, y string, z string")[0]
    assert (row.x, row.y, row.z) == ("", "a", "")
    row = decoded(spark, [",a\\\\,"], "x string, y string, z string")[0]
    assert (row.x, row.y, row.z) == ("", "a\\", "")
    row = decoded(spark, [",,"], "x int, y date, z string")[0]
    assert (row.x, row.y, row.z, row._reject_reason) == (None, None, "", None)


def test_null_token_is_compared_before_unescaping(spark):
    opts = LoadOptions(null_string="\\\\N")
    rows = decoded(spark, ["\\N,\\N", "1,\\\\N", "1,N"], "a int, b string", opts)
    assert values(rows, "b") == [None, "\\N", "N"]
    assert rows[0].a is None


@pytest.mark.parametrize(
    "ddl,token,other",
    [("int", "0", "1"), ("decimal(5,2)", "-1", "1"), ("double", "NaN", "1"),
     ("boolean", "false", "true"), ("date", "1970-01-01", "1970-01-02"), ("string", "7", "8")],
)
def test_null_tokens_that_are_values(spark, ddl, token, other):
    opts = LoadOptions(null_string=token, null_non_string=token)
    rows = decoded(spark, [f"{token},1", f"{other},1"], f"v {ddl}, n tinyint", opts)
    assert [r.v is None for r in rows] == [True, False]
    assert values(rows, "_reject_reason") == [None, None]


def test_null_token_with_two_backslashes(spark):
    opts = LoadOptions(null_string="\\\\\\\\N", ctrl_chars=True)
    assert opts.null_token == "\\\\N"
    lines = ["\\\\N,1", "\\\\N\x00,1", "\\N,1", "\x00N,1"]
    assert values(decoded(spark, lines, "s string, n int", opts), "s") == [
        None, "\\N\x00", "N", "\x00N"
    ]


def test_very_long_lines(spark):
    lines = ["\\," * 200_000 + ",1", "x" * 800_000 + "\\\\,2", "\\\\" * 100_000 + ",3"]
    rows = decoded(spark, lines, "s string, n int")
    assert values(rows, "n") == [1, 2, 3]
    assert [len(r.s) for r in rows] == [200_000, 800_001, 100_000]


# ----------------------------------------------- brute force and round trips

def model_split(line, delim):
    """Character-by-character reading of a line."""
    fields, now, i = [], "", 0
    while i < len(line):
        if line[i] == "\\" and i + 1 < len(line):
            now += line[i + 1]
            i += 2
        elif line[i] == delim:
            fields.append(now)
            now = ""
            i += 1
        else:
            now += line[i]
            i += 1
    return [*fields, now]


awkward = st.text(alphabet="ab,|\\\n\r\tNnull ž😀\x1e", max_size=12)
relaxed = settings(
    max_examples=12, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


@relaxed
@given(
    rows=st.lists(st.tuples(awkward, st.none() | awkward, st.none() | st.integers(-99, 99)),
                  min_size=1, max_size=30),
    delim=st.sampled_from([",", "|", "\t", "ž", "-", ".", "\x00", "\x01", "^", "]", "😀"]),
)
def test_round_trip(spark, rows, delim):
    df = spark.createDataFrame(rows, "a string, b string, c int")
    out = UnloadOptions(field_delim=delim, null_string="\\\\N", newline_policy="escape",
                        record_sep="\x1d", ctrl_chars=True)
    back = LoadOptions(field_delim=delim, null_string="\\\\N", record_sep="\x1d", ctrl_chars=True)
    got = decode(encode(df, out), df.schema, back).collect()
    assert [(r.a, r.b, r.c) for r in got] == rows
    assert values(got, "_reject_reason") == [None] * len(rows)


@relaxed
@given(
    lines=st.lists(st.text(alphabet="ab,\\\x00\x01", max_size=15), min_size=1, max_size=40),
)
def test_split_agrees_with_brute_force(spark, lines):
    clean = [x for x in lines if (len(x) - len(x.rstrip("\\"))) % 2 == 0]
    if not clean:
        return
    from ferryline.functions import codec

    df = spark.createDataFrame([(x,) for x in clean], "value string")
    line = F.col("value")
    marked = codec.is_marked(line, ",", "\n")
    raw = codec.raw_fields(line, marked, ",", "\n")
    got = df.select(codec.text_fields(line, raw, marked, ",", "\n").alias("p"))
    assert [r.p for r in got.collect()] == [model_split(x, ",") for x in clean]
