"""Unload: rows to a directory of delimited text."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ferryline.errors import RejectBudgetExceeded
from ferryline.operators.encode import REASONS, VALUE, can_reject, encode
from ferryline.operators.rules import REJECT_COLUMN, REJECT_REASON
from ferryline.options import UnloadOptions, check_direct
from ferryline.plans import report
from ferryline.shared import delete_path, stored, touch
from ferryline.sources.table import Table

_SUCCESS_MARK = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def unload(df: DataFrame, path: str, opts: UnloadOptions | None = None) -> dict:
    """Write ``df`` to ``path`` as escaped text; returns the summary of the run.

    One pass without a shuffle: every input partition becomes a part file. Rows
    without a valid record are counted by the same job, which leaves out the
    ``_SUCCESS`` mark; the mark is set when the count is below ``max_errors``,
    else the output is removed again. So nothing is moved or written twice.

    Where rejects are to be stored and the budget allows some, the encoded rows are
    stored first, so that the rejects are those that were counted even if ``df``
    changes between reads. With the default budget a failed run reads ``df`` again
    to report its rejects.
    """
    opts = opts or UnloadOptions()
    encoded = encode(df, opts)
    keeps_rejects = opts.max_errors > 1 and (opts.rejects_path or "").strip()
    if keeps_rejects and can_reject(df, opts):
        with stored(encoded, "unload") as rows:
            return _write(df, rows, path, opts)
    return _write(df, encoded, path, opts)


def _write(df: DataFrame, encoded: DataFrame, path: str, opts: UnloadOptions) -> dict:
    spark, load_id = df.sparkSession, uuid.uuid4().hex
    counts = Observation("unload")
    observed = encoded.observe(
        counts,
        F.count(F.lit(1)).alias("read"),
        *[F.count_if(F.col(REJECT_REASON) == r).alias(r) for r in REASONS],
    )
    lines = observed.where(F.col(REJECT_REASON).isNull()) if can_reject(df, opts) else observed
    writer = lines.select(VALUE).write.option("lineSep", opts.record_sep)
    if opts.compression:
        writer = writer.option("compression", opts.compression)
    writer.option(_SUCCESS_MARK, "false").text(path)

    by_reason = {r: n for r, n in counts.get.items() if r in REASONS and n}
    rejected = sum(by_reason.values())
    if rejected:
        report.write_rejects(
            encoded.where(F.col(REJECT_REASON).isNotNull()).select(
                F.col(VALUE).alias("raw"),
                F.col(REJECT_COLUMN).alias("column"),
                F.col(REJECT_REASON).alias("reason"),
            ),
            opts.rejects_path,
            load_id,
        )
    aborted = rejected >= opts.max_errors
    summary = report.summary(load_id, path, counts.get["read"], by_reason, aborted)
    if aborted:
        delete_path(spark, path)
    report.write_summary(spark, summary, opts.rejects_path)
    if aborted:
        raise RejectBudgetExceeded(
            f"{rejected} rows have no valid record, max_errors is {opts.max_errors}", summary
        )
    touch(spark, f"{path.rstrip('/')}/_SUCCESS")
    return summary


def unload_table(
    spark: SparkSession,
    source: Table,
    path: str,
    opts: UnloadOptions | None = None,
    *,
    layout: str = "text",
    query: str | None = None,
) -> dict:
    """Direct transfer of a table: all checks first, then :func:`unload`."""
    opts = opts or UnloadOptions()
    check_direct(opts, layout=layout, query=query)
    source.require_table(spark)
    return unload(source.read(spark), path, opts)
