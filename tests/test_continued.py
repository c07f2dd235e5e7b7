"""Records with escaped line feeds, whatever the blocks they are read in."""

import os
import random

import pyarrow as pa
import pytest

from ferryline import Directory, LoadOptions, RejectBudgetExceeded, UnloadOptions, load, unload
from ferryline.sources.continued import is_continued, read_continued


def plain(text):
    """Records of a file: a line feed ends one unless an odd run of backslashes stands before it."""
    records, at = [], ""
    for line in text.removesuffix("\n").split("\n") if text else []:
        at += line
        if (len(line) - len(line.rstrip("\\"))) % 2:
            at += "\n"
            continue
        records.append(at)
        at = ""
    return records + ([at.removesuffix("\n")] if at else [])


def made(seed, n):
    draw = random.Random(seed)
    parts = ["a", "bc", "\\\\", "\\\n", "\n", "\\\\\n", "\\\\\\\n", ",", "\\\n\\\n\\\n", "é" * 20]
    return "".join(draw.choice(parts) for _ in range(n)) + "end\n"


@pytest.fixture
def blocks_of(spark):
    def set_(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield set_
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [40, 333, 10**6])
def test_records_over_block_ends(spark, new_dir, blocks_of, size):
    folder = new_dir("in")
    os.makedirs(folder)
    texts = [made(i, 400) for i in range(3)] + ["x\\\n" * 300 + "end\n", "one\\\n", "", "\n\n", "no end"]
    for i, text in enumerate(texts):
        with open(f"{folder}/f{i}", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    blocks_of(size)
    got = sorted(r.value for r in read_continued(spark, folder).collect())
    assert got == sorted(r for t in texts for r in plain(t))


def test_small_arrow_batches(spark, new_dir):
    folder = new_dir("in")
    os.makedirs(folder)
    with open(f"{folder}/f", "w", encoding="utf-8", newline="") as f:
        f.write(made(9, 3000))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(r.value for r in read_continued(spark, folder).collect()) == sorted(plain(made(9, 3000)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_continued_lines():
    lines = ["", "a", "\\", "\\\\", "\\\\\\", "a\\", "\\a"]
    assert is_continued(pa.array([x.encode() for x in lines])).tolist() == [False, False, True, False, True, True, False]


def test_round_trip(spark, new_dir, blocks_of):
    rows = [(i, t) for i, t in enumerate(["a\nb", "\n", "\\", "\\\n", "a,\r\n\\\\", "", None, "x" * 500 + "\n" * 50])]
    df = spark.createDataFrame(rows, "a int, b string").coalesce(1)
    path, target = new_dir(), new_dir("target")
    unload(df, path, UnloadOptions(newline_policy="continue", null_string="\\\\N"))
    blocks_of(64)
    load(spark, path, Directory(target), LoadOptions(continued_lines=True, null_string="\\\\N"), schema=df.schema)
    assert sorted(map(repr, spark.read.parquet(target).collect())) == sorted(map(repr, df.collect()))


def test_rejects_of_continued_records(spark, new_dir):
    folder, shared = new_dir("in"), new_dir("rejects")
    os.makedirs(folder)
    with open(f"{folder}/f", "w", newline="") as f:
        f.write("1,a\\\nb\nx,c\\\nd\n2,open\\\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    opts = LoadOptions(continued_lines=True, max_errors=9, rejects_path=shared)
    target = new_dir("target")
    load(spark, folder, Directory(target), opts, schema=schema)
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [(1, "a\nb")]
    rejects = spark.read.json(f"{shared}/rejects").collect()
    assert sorted((r.reason, r.raw, os.path.basename(r["_source_file"])) for r in rejects) == [
        ("dangling_escape", "2,open\\", "f"), ("invalid_integer", "x,c\\\nd", "f")]
    with pytest.raises(RejectBudgetExceeded):
        load(spark, folder, Directory(new_dir()), LoadOptions(continued_lines=True), schema=schema)


def test_bytes_that_are_no_text(spark, new_dir):
    folder, shared = new_dir("in"), new_dir("rejects")
    os.makedirs(folder)
    with open(f"{folder}/f", "wb") as f:
        f.write(b"1,a\xff\\\nb\n2,ok\\\nok\n3,\xc0\x80\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    opts, target = LoadOptions(continued_lines=True, max_errors=9, rejects_path=shared), new_dir("target")
    load(spark, folder, Directory(target), opts, schema=schema)
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [(2, "ok\nok")]
    rejects = spark.read.json(f"{shared}/rejects").collect()
    assert sorted((r.reason, r.raw[:4]) for r in rejects) == [("invalid_utf8", "1,a\ufffd"), ("invalid_utf8", "3,\ufffd\ufffd")]


def test_options():
    with pytest.raises(ValueError, match="LF"):
        LoadOptions(continued_lines=True, record_sep="\x1e")
    with pytest.raises(ValueError, match="LF"):
        UnloadOptions(newline_policy="continue", record_sep="\x1e")
