"""Rejected rows and run summaries, written by Spark to the shared path.

Every run writes below ``load_id=<id>``, which reads back as a column, so runs that
share the path never touch each other's files.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession

SUMMARY_SCHEMA = (
    "load_id string, location string, rows_read bigint, rows_loaded bigint,"
    " rows_rejected bigint, aborted boolean, by_reason map<string, bigint>"
)


def summary(
    load_id: str, location: str, read: int, by_reason: dict[str, int], aborted: bool
) -> dict:
    rejected = sum(by_reason.values())
    return {
        "load_id": load_id,
        "location": location,
        "rows_read": read,
        "rows_loaded": 0 if aborted else read - rejected,
        "rows_rejected": rejected,
        "aborted": aborted,
        "by_reason": by_reason,
    }


def write_rejects(rejects: DataFrame, rejects_path: str | None, load_id: str) -> None:
    """Store the rejected records of one run; skipped when no path is set."""
    if rejects_path and rejects_path.strip():
        rejects.write.json(f"{rejects_path.rstrip('/')}/rejects/load_id={load_id}")


def write_summary(spark: SparkSession, figures: dict, rejects_path: str | None) -> None:
    """Store the one-row log of a run; skipped when no path is set.

    Rows may be in the target by now, so a log that cannot be written is a warning:
    an error would invite a second load.
    """
    if rejects_path and rejects_path.strip():
        try:
            summary_frame(spark, figures).drop("load_id").write.json(
                f"{rejects_path.rstrip('/')}/summary/load_id={figures['load_id']}"
            )
        except Exception as exc:
            warnings.warn(f"the summary of the run could not be stored: {exc}", stacklevel=2)


def summary_frame(spark: SparkSession, figures: dict) -> DataFrame:
    return spark.createDataFrame([figures], SUMMARY_SCHEMA).coalesce(1)
