"""Shared storage for intermediate tables.

Intermediate results are written as parquet under the folder that the cluster
names in ``spark.checkpoint.dir``, so they outlive any executor and cut lineage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@lru_cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"ferryline-{application}-")


def new_path(spark: SparkSession, purpose: str) -> str:
    """A path nobody else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, purpose: str = "stage", compression: str | None = None
) -> DataFrame:
    """Write ``df`` once and read it back: stable rows, no lineage."""
    spark = df.sparkSession
    path = new_path(spark, purpose)
    writer = df.write if compression is None else df.write.option("compression", compression)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, purpose: str = "stage") -> Iterator[DataFrame]:
    """``df`` written once and read back; deleted afterwards, also when writing fails."""
    spark = df.sparkSession
    path = new_path(spark, purpose)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a directory this library created."""
    target, fs = _file_system(spark, path)
    fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    target, fs = _file_system(spark, path)
    fs.create(target, True).close()


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename in one step unless ``target`` exists; whether it was done.

    File systems with atomic renames let one of several callers win.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(
        hadoop.Path(target).toUri() if "://" in target else hadoop.Path(target).getFileSystem(
            spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").NONE
    try:
        context.rename(hadoop.Path(source), hadoop.Path(target), options)
    except Exception:
        if exists(spark, target):
            return False
        raise
    return True


def make_dir(spark: SparkSession, path: str) -> None:
    target, fs = _file_system(spark, path)
    fs.mkdirs(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; none if there is no such directory."""
    target, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of this library's own."""
    target, fs = _file_system(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    target, fs = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
