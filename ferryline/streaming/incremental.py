"""Incremental reads: bounded batches that carry a high-water mark between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.functions.names import quote_column, quote_identifier
from ferryline.operators.slices import exact_literal, exact_row, sql_literal


def incremental(df: DataFrame, col: str, last=None) -> tuple[DataFrame, object]:
    """Rows with ``last < col <= hi`` and the new mark ``hi``.

    Serves both kinds of incremental transfer: a growing key (append) and a
    modification time. ``hi`` is fetched once, as a single value, and bounds the
    batch, so rows that arrive during the run belong to the next one. Rows that
    arrive later with a value at or below ``hi`` are not seen again. Both
    conditions reach the scan.

    Marks of a ``timestamp`` column are instants (aware, UTC), those of a
    ``timestamp_ntz`` column are naive; neither depends on the zone of any process.
    Rows whose ``col`` is NULL belong to the first batch (``last`` is None), and to
    none after it; as long as there are only such rows, the mark stays None.
    """
    value, kind = F.col(quote_column(col)), df.schema[col].dataType
    fresh = df if last is None else df.where(value > exact_literal(last, kind))
    (hi,) = exact_row(fresh, F.max(value))
    if hi is None:
        return (df.where(value.isNull()) if last is None else df.where(F.lit(False))), last
    within = value <= exact_literal(hi, kind)
    return fresh.where(within | value.isNull() if last is None else within), hi


def incremental_condition(col: str, last, hi) -> str:
    """The same bounds as a condition for a warehouse read (quoted ``col``).

    Rows without a value satisfy neither form; read them with a condition of their own.
    """
    name = quote_identifier(col)
    upper = f"{name} <= {sql_literal(hi)}"
    return upper if last is None else f"{name} > {sql_literal(last)} AND {upper}"
