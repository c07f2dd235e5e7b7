"""Load: delimited text or typed records into a table."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.errors import RejectBudgetExceeded
from ferryline.functions.names import quote_column
from ferryline.operators.decode import RAW, decode, rejected
from ferryline.operators.encode import VALUE, encode
from ferryline.operators.rules import REJECT_COLUMN, REJECT_REASON
from ferryline.options import LoadOptions, UnloadOptions, check_direct
from ferryline.plans import report
from ferryline.plans.watch import BudgetReached, RejectWatch
from ferryline.shared import delete_path, new_path
from ferryline.sinks.published import Published
from ferryline.sinks.published import publish as publish_rows
from ferryline.sinks.target import Directory, append
from ferryline.sources.continued import read_continued
from ferryline.sources.records import read_records
from ferryline.sources.table import Table
from ferryline.sources.text import PROVENANCE, read_lines


#: Rejected lines that are looked up and stored after a job was stopped early.
STOPPED_REJECTS = 10_000

#: Takes the accepted rows and whether they read a stored table.
Publish = Callable[[DataFrame, bool], None]

_IS_REJECT = "_is_reject"
_REJECTED = "a line was rejected and the budget is one"


@dataclass(frozen=True)
class Stage:
    """Decoded lines, stored once: loadable and rejected rows in one table."""

    rows: DataFrame
    schema: T.StructType
    path: str

    def accepted(self) -> DataFrame:
        return self.rows.where(F.col(REJECT_REASON).isNull()).select(
            *map(quote_column, self.schema.names))

    def rejected(self) -> DataFrame:
        return rejected(self.rows, _provenance(self.rows))


def _provenance(lines: DataFrame) -> list[str]:
    """The columns that tell where a line comes from, if it carries them."""
    return [c for c in PROVENANCE if c in lines.columns]


def stage(
    spark: SparkSession, lines: DataFrame, schema: T.StructType, opts: LoadOptions,
    watch: RejectWatch | None = None,
) -> Stage:
    """Decode ``lines`` and store the result in one pass without a shuffle.

    Raw text and provenance are kept for rejected lines only, so the stage costs little more
    than the typed columns, and row groups without rejects are skipped when the
    rejects are read. With a ``watch`` the pass ends as soon as the budget is reached.
    """
    decoded = decode(lines, schema, opts, keep=_provenance(lines))
    path = new_path(spark, "load")
    is_reject = F.col(REJECT_REASON).isNotNull()
    kept = decoded.withColumn(_IS_REJECT, watch.counted(is_reject) if watch else is_reject).withColumns({
        c: F.when(F.col(_IS_REJECT), F.col(c))
        for c in (RAW, REJECT_COLUMN, REJECT_REASON, *_provenance(lines))
    }).drop(_IS_REJECT)
    if watch is None:
        _store(spark, kept, path)
    else:
        watch.run(lambda: _store(spark, kept, path))
    return Stage(spark.read.schema(kept.schema).parquet(path), schema, path)


def _stopped(
    spark: SparkSession, lines: DataFrame, schema: T.StructType, opts: LoadOptions,
    watch: RejectWatch, load_id: str, location: str,
) -> RejectBudgetExceeded:
    """Report a job that was stopped: its first rejects, looked up partition by partition.

    Spark reads ever more partitions until it has as many rejected lines as the budget (at most
    ``STOPPED_REJECTS``), so this ends where the stopped job has been. The summary counts
    the lines that were stored; ``rows_read`` is what the tasks that ended have read.
    """
    bad = decode(lines, schema, opts, keep=_provenance(lines))
    found = rejected(bad, _provenance(lines)).limit(min(opts.max_errors, STOPPED_REJECTS))
    first = spark.createDataFrame(found.collect(), found.schema)
    counts = Counter(r["reason"] for r in first.select("reason").collect())
    n = sum(counts.values())
    summary = report.summary(load_id, location, max(watch.read, n), dict(counts), True)
    report.write_rejects(first, opts.rejects_path, load_id)
    report.write_summary(spark, summary, opts.rejects_path)
    return RejectBudgetExceeded(
        f"stopped after {max(watch.rejected, n)} rejected lines, max_errors is {opts.max_errors}", summary)


def _store(spark: SparkSession, rows: DataFrame, path: str) -> None:
    try:
        rows.write.parquet(path)
    except Exception:
        delete_path(spark, path)
        raise


def _rejects_only(
    spark: SparkSession, lines: DataFrame, schema: T.StructType, opts: LoadOptions
) -> tuple[Stage, int]:
    """The rejected lines, stored, and the number of all lines; one pass, nothing else kept."""
    counts = Observation("rejects")
    decoded = decode(lines, schema, opts, keep=_provenance(lines), observation=counts)
    path = new_path(spark, "rejects")
    _store(spark, decoded.where(F.col(REJECT_REASON).isNotNull()), path)
    return Stage(spark.read.schema(decoded.schema).parquet(path), schema, path), counts.get["read"]


def load_lines(
    spark: SparkSession,
    lines: DataFrame,
    schema: T.StructType,
    publish: Publish,
    opts: LoadOptions | None = None,
    *,
    location: str = "",
    load_id: str | None = None,
) -> dict:
    """Decode, check the budget, publish the accepted rows.

    The budget covers the whole job, and nothing is published beyond it. With
    the default budget the first rejected line fails the job, so clean input is
    read and written once. Any other budget needs the number of rejects before
    the target is touched: the decoded lines are stored, counted by reading one
    column of what was actually stored, and then published from there. Rejects are counted
    while that job runs too (:class:`RejectWatch`), which stops it once the budget is reached. After a
    failure of the default budget one more pass stores the rejected lines alone, for
    the report. Rejects and summary are written in either case.
    """
    opts = opts or LoadOptions()
    load_id = load_id or uuid.uuid4().hex
    if opts.max_errors == 1:
        try:
            read = _publish_clean(lines, schema, publish, opts)
        except PySparkException as exc:
            if _REJECTED not in str(exc):
                raise
        else:
            summary = report.summary(load_id, location, read, {}, False)
            report.write_summary(spark, summary, opts.rejects_path)
            return summary

    total = None
    if opts.max_errors == 1:
        staged, total = _rejects_only(spark, lines, schema, opts)
    else:
        watch = RejectWatch(spark, opts.max_errors)
        try:
            staged = stage(spark, lines, schema, opts, watch)
        except BudgetReached:
            raise _stopped(spark, lines, schema, opts, watch, load_id, location) from None
    reasons = staged.rows.groupBy(F.col(REJECT_REASON).alias("reason"))
    counts = {r["reason"]: r["count"] for r in reasons.count().collect()}
    total = sum(counts.values()) if total is None else total
    counts.pop(None, None)
    bad = sum(counts.values())
    aborted = bad >= opts.max_errors
    summary = report.summary(load_id, location, total, counts, aborted)
    try:
        if bad:
            report.write_rejects(staged.rejected(), opts.rejects_path, load_id)
        if not aborted:
            publish(staged.accepted(), True)
        report.write_summary(spark, summary, opts.rejects_path)
    finally:
        delete_path(spark, staged.path)
    if aborted:
        raise RejectBudgetExceeded(
            f"{bad} lines rejected, max_errors is {opts.max_errors}", summary
        )
    return summary


def _publish_clean(
    lines: DataFrame, schema: T.StructType, publish: Publish, opts: LoadOptions
) -> int:
    """Publish in one pass, failing on any rejected line; returns the rows read."""
    counts = Observation("load")
    decoded = decode(lines, schema, opts, observation=counts)
    passes = F.when(F.col(REJECT_REASON).isNull(), True).otherwise(
        F.raise_error(F.lit(_REJECTED)).cast("boolean")
    )
    publish(decoded.where(passes).select(*map(quote_column, schema.names)), False)
    return counts.get["read"]


def load(
    spark: SparkSession,
    path: str,
    target: Table | Directory | Published,
    opts: LoadOptions | None = None,
    *,
    schema: T.StructType | None = None,
    layout: str = "text",
    mode: str = "append",
    max_connections: int = 32,
    batch_size: int = 1000,
    load_id: str | None = None,
) -> dict:
    """Direct transfer of a text directory into a table.

    Fields bind to the target's columns by position; ``schema`` is needed only
    for a directory target or to declare narrower columns than the catalog. A load into a
    ``Published`` directory needs a ``load_id``; if that id is there already, nothing is read or added.
    """
    opts = opts or LoadOptions()
    check_direct(opts, layout=layout, mode=mode)
    if isinstance(target, Published):
        if load_id is None:
            raise ValueError("a load into a published directory needs a load_id")
        if target.has(spark, load_id):
            return report.summary(load_id, path, 0, {}, False)

        def publish(rows: DataFrame, stored: bool) -> None:
            publish_rows(rows, target, load_id)
    else:
        publish = _publisher(spark, target, schema, max_connections, batch_size)
    schema = check_target(spark, target, schema)
    lines = read_records_of_text(spark, path, opts)
    return load_lines(spark, lines, schema, publish, opts, location=path, load_id=load_id)


def read_records_of_text(spark: SparkSession, path: str, opts: LoadOptions) -> DataFrame:
    """The lines or continued lines of a load, with their provenance where rejects are stored."""
    provenance = bool((opts.rejects_path or "").strip())
    if opts.continued_lines:
        return read_continued(spark, path, provenance=provenance)
    return read_lines(spark, path, opts.record_sep, provenance=provenance)


def load_records(
    spark: SparkSession,
    path: str,
    target: Table | Directory,
    opts: LoadOptions | None = None,
    *,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    max_connections: int = 32,
    batch_size: int = 1000,
) -> dict:
    """Direct transfer of typed records.

    They pass through the same text form as everything else, with the
    configured delimiter, so the rules of the target apply to them alike.
    """
    opts = opts or LoadOptions()
    check_direct(opts)
    publish = _publisher(spark, target, schema, max_connections, batch_size)
    schema = check_target(spark, target, schema)
    lines = record_lines(read_records(spark, path, fmt), opts)
    return load_lines(spark, lines, schema, publish, opts, location=path)


def _publisher(
    spark: SparkSession, target: Table | Directory, schema: T.StructType | None,
    max_connections: int, batch_size: int,
) -> Publish:
    """Append by position: a ``schema`` in other words than the target's gets its names."""
    names = None
    if schema is not None and isinstance(target, Table) and target.connection is not None:
        target.require_table(spark)
        declared = target.struct(spark).names
        names = declared if len(declared) == len(schema) else None
    return partial(append, target, names=names, max_connections=max_connections,
                   batch_size=batch_size)


def record_lines(records: DataFrame, opts: LoadOptions) -> DataFrame:
    """Typed records as lines that ``opts`` reads back."""
    # The lines go straight to the decoder, never to a file, so a line end in a
    # string needs no rule of its own beyond the escape.
    text = UnloadOptions(
        field_delim=opts.field_delim,
        null_string=opts.null_string,
        null_non_string=opts.null_non_string,
        bool_style=opts.bool_style,
        ctrl_chars=True,
        newline_policy="escape",
        record_sep="\x1e" if opts.record_sep == "\n" else opts.record_sep,
    )
    return encode(records, text).select(VALUE)


def check_target(
    spark: SparkSession,
    target: Table | Directory | Published,
    schema: T.StructType | None,
    *,
    tables_only: bool = True,
) -> T.StructType:
    """The schema that fields bind to, after checking it against the target."""
    if isinstance(target, (Directory, Published)):
        if schema is None:
            raise ValueError("a directory target needs a schema")
        return schema
    if tables_only:
        target.require_table(spark)
    declared = target.struct(spark)
    if schema is not None and len(schema) != len(declared):
        raise ValueError(
            f"schema has {len(schema)} columns, the target has {len(declared)}"
        )
    return schema or declared
