"""Directories that change by whole loads, each of them once.

A load is written beside the data, where readers do not look, and appears by one rename to
``load_id=<id>``. A load that fails leaves nothing to be seen. A load id that is there already adds
nothing, so a load may be repeated until it has succeeded; of two writers with one id
one is published. Needs a file system on which a rename is atomic.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ferryline.shared import children, delete_path, exists, make_dir, move_new

_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
LOAD_ID = "load_id"


@dataclass(frozen=True)
class Published:
    """A directory of record files as a target of loads with ids."""

    path: str
    fmt: str = "parquet"

    def place(self, load_id: str) -> str:
        if not _ID.fullmatch(load_id):
            raise ValueError(f"a load id is made of letters, digits, '.', '_' and '-': {load_id!r}")
        return f"{self.path.rstrip('/')}/{LOAD_ID}={load_id}"

    def has(self, spark: SparkSession, load_id: str) -> bool:
        return exists(spark, self.place(load_id))

    def load_ids(self, spark: SparkSession) -> list[str]:
        """The loads that are published."""
        start = f"{LOAD_ID}="
        return sorted(n.removeprefix(start) for n in children(spark, self.path) if n.startswith(start))

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """All published rows; no rows before the first load."""
        if not self.load_ids(spark):
            return spark.createDataFrame([], schema)
        return spark.read.format(self.fmt).schema(schema).load(self.path).select(*[f"`{c}`" for c in schema.names])


def publish(rows: DataFrame, target: Published, load_id: str) -> bool:
    """Write ``rows`` and publish them as ``load_id``; False if that id was published before."""
    spark, place = rows.sparkSession, target.place(load_id)
    if exists(spark, place):
        return False
    if LOAD_ID in (c.lower() for c in rows.columns):
        raise ValueError(f"column name is reserved: {LOAD_ID}")
    make_dir(spark, target.path)
    staging = f"{target.path.rstrip('/')}/_staging-{load_id}-{uuid.uuid4().hex}"
    try:
        rows.write.format(target.fmt).save(staging)
        if move_new(spark, staging, place):
            return True
    except Exception:
        delete_path(spark, staging)
        raise
    delete_path(spark, staging)
    return False
