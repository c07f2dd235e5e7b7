"""Typed record files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Record formats that carry their own schema.
RECORD_FORMATS = ("parquet", "orc")


def read_records(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt not in RECORD_FORMATS:
        raise ValueError(f"record format must be one of {RECORD_FORMATS}")
    return spark.read.format(fmt).load(path)
