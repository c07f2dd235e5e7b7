"""Delimited text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Where a record comes from: its file, the start of the block of the file that a task
#: read it in, and that task's partition.
PROVENANCE = ("_source_file", "_source_block", "_source_partition")


def read_lines(
    spark: SparkSession, path: str, record_sep: str = "\n", *, provenance: bool = False
) -> DataFrame:
    """One row ``value`` per record, with the ``PROVENANCE`` columns if asked for.

    The separator is set explicitly: by default Spark would also end a record at
    a lone CR. Files stay splittable, so large files are read in parallel.
    """
    lines = spark.read.text(path, lineSep=record_sep)
    if not provenance:
        return lines
    of_file = F.col("_metadata")
    values = (of_file["file_path"], of_file["file_block_start"], F.spark_partition_id())
    return lines.select("value", *[v.alias(name) for v, name in zip(values, PROVENANCE)])
