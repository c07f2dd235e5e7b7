"""The non-direct mode: any layout, views and queries, append or update."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ferryline.options import DEFAULT_NULL_TOKEN, LoadOptions, UnloadOptions
from ferryline.plans.load import check_target, load_lines, read_records_of_text
from ferryline.plans.unload import unload
from ferryline.sinks import jdbc
from ferryline.sinks.target import Directory, append
from ferryline.sources.records import RECORD_FORMATS, read_records
from ferryline.sources.table import Table


def import_rows(df: DataFrame, path: str, fmt: str = "text",
                opts: UnloadOptions | None = None) -> dict | None:
    """Write a table, view or query result as text or as typed records."""
    if fmt in RECORD_FORMATS:
        df.write.format(fmt).save(path)
        return None
    if fmt != "text":
        raise ValueError(f"format must be 'text' or one of {RECORD_FORMATS}")
    return unload(df, path, _row_wise(opts or UnloadOptions()))


def export_dir(
    spark: SparkSession,
    path: str,
    target: Table | Directory,
    fmt: str = "text",
    opts: LoadOptions | None = None,
    *,
    schema: T.StructType | None = None,
    update_keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
    num_writers: int = 1,
    max_connections: int = 32,
    batch_size: int = 1000,
) -> dict | None:
    """Append a directory to a table, or update the table by key from it.

    ``order_by`` names the columns of typed records that order repeated keys; they are not
    written. Lines of text bind to the target's columns, so there it names some of these.
    """
    if order_by and not update_keys:
        raise ValueError("order_by is for updates by key")
    if update_keys:
        if not isinstance(target, Table) or target.connection is None:
            raise ValueError("update mode needs a warehouse table; see update_by_key for files")

        def publish(rows: DataFrame, stored: bool) -> None:
            jdbc.update_table(
                rows, target.connection, target.name, list(update_keys),
                schema=target.schema, order_by=list(order_by), num_writers=num_writers,
                max_connections=max_connections, batch_size=batch_size,
            )
    else:
        publish = partial(append, target, max_connections=max_connections, batch_size=batch_size)
    if fmt in RECORD_FORMATS:
        publish(read_records(spark, path, fmt), True)
        return None
    opts = _row_wise(opts or LoadOptions())
    lines = read_records_of_text(spark, path, opts)
    schema = check_target(spark, target, schema, tables_only=False)
    return load_lines(spark, lines, schema, publish, opts, location=path)


def _row_wise(opts):
    """Outside direct mode NULL has the same default token in every column."""
    if opts.null_non_string is None:
        return replace(opts, null_non_string=DEFAULT_NULL_TOKEN)
    return opts
