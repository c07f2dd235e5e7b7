"""Incremental reads that find rows which arrive late, within a bounded look-back.

A ledger keeps the keys of the rows that were handed over with values in the last
``look_back`` before the mark, and so the mark itself. A batch reads from ``look_back`` before the mark on
and leaves out the rows in the ledger (an anti-join by key), so a row that arrives
late within that span is handed over once, and none twice. The ledger's size is bounded by the rows in
the span, whatever the table holds. Rows that arrive later than that are not seen.

The batch is stored once: what is published and what goes into the ledger are the same rows, even
if the source grows meanwhile. ``commit`` puts the new ledger in place by one rename, after
the rows are safe at their target; a run that ends before it is repeated by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.errors import TransferError
from ferryline.functions.names import quote_column
from ferryline.operators.slices import exact_literal, exact_row
from ferryline.shared import children, delete_path, materialize, move_new

_STATE = "state-"


@dataclass(frozen=True)
class Batch:
    """Stored rows to publish, and the ledger they lead to."""

    rows: DataFrame
    mark: object
    _spark: SparkSession
    _seen: DataFrame
    _path: str
    _number: int

    def commit(self) -> None:
        """Make the batch part of the ledger. Call it when its rows are published."""
        hidden = f"{self._path}/_state-{uuid.uuid4().hex}"
        self._seen.write.parquet(hidden)
        if not move_new(self._spark, hidden, f"{self._path}/{_STATE}{self._number:010}"):
            delete_path(self._spark, hidden)
            raise TransferError("another run has committed its batch meanwhile; this one must be repeated")
        for name in _states(self._spark, self._path)[:-2]:  # the state before stays for a reader that has begun
            delete_path(self._spark, f"{self._path}/{name}")


def late_batch(df: DataFrame, col: str, keys: Sequence[str], ledger: str, look_back) -> Batch:
    """The next batch of ``df`` by the values of ``col``, late rows included.

    ``keys`` identify a row (NULL equals NULL). ``look_back`` is a number, or a ``timedelta`` for dates and
    times. Rows without a value belong to the first batch only, as in :func:`incremental`.
    """
    spark, keys, ledger = df.sparkSession, list(keys), ledger.rstrip("/")
    value, kind = F.col(quote_column(col)), df.schema[col].dataType
    states = _states(spark, ledger)
    number = int(states[-1].removeprefix(_STATE)) + 1 if states else 0
    old, last = None, None
    if states:
        old = spark.read.parquet(f"{ledger}/{states[-1]}")
        (last,) = exact_row(old, F.max("_mark"))
    hi = exact_row(df if last is None else df.where(value > exact_literal(last, kind)), F.max(value))[0]
    hi = last if hi is None else hi
    if hi is None:
        fresh = df.where(value.isNull()) if not states else df.where(F.lit(False))
    elif last is None:
        upper = value <= exact_literal(hi, kind)
        fresh = df.where(upper if states else upper | value.isNull())
    else:
        span = df.where((value > exact_literal(last - look_back, kind)) & (value <= exact_literal(hi, kind)))
        known = old.select(*[F.col(f"k{i}").alias(f"_ledger_{i}") for i in range(len(keys))])
        same = reduce(lambda a, b: a & b, [
            F.col(quote_column(k)).eqNullSafe(F.col(f"_ledger_{i}")) for i, k in enumerate(keys)])
        fresh = span.join(known, same, "left_anti")
    rows = materialize(fresh, "batch")
    named = [F.col(quote_column(k)).alias(f"k{i}") for i, k in enumerate(keys)]
    seen = rows.select(*named, value.alias("_value"))
    if old is not None:
        seen = seen.unionByName(old.where("_value IS NOT NULL").select(*[f"k{i}" for i in range(len(keys))], "_value"))
    if hi is not None:
        seen = seen.where(F.col("_value") > exact_literal(hi - look_back, kind))
        seen = seen.withColumn("_mark", exact_literal(hi, kind).cast(kind))
    else:
        seen = seen.where(F.lit(False)).withColumn("_mark", F.lit(None).cast(kind))
    return Batch(rows, hi, spark, seen, ledger, number)


def _states(spark: SparkSession, ledger: str) -> list[str]:
    return sorted(n for n in children(spark, ledger) if n.startswith(_STATE))
