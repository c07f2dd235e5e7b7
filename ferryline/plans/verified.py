"""Copies in slices that are checked against their source and repaired slice by slice.

Slices of a sliced read are statements of their own, not one snapshot. Each slice of source and copy gets a
digest of its rows as a multiset: their number, the sum and the exclusive-or of a hash of
each row. Digests do not depend on the order of rows, and tasks add them up before anything is
shuffled, so a comparison moves a few numbers per slice and task. Only slices whose digests differ are read and
written again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.errors import TransferError
from ferryline.functions.names import quote_column
from ferryline.shared import delete_path

SLICE = "slice"
_DIGEST = ("rows", "total", "mixed")


def row_hash(columns: Sequence[Column], seed: int) -> Column:
    """A 64-bit hash in which NULL and each column's place count."""
    parts = [part for c in columns for part in (c.isNull(), c)]
    return F.xxhash64(F.lit(seed), *parts)


def slice_digests(df: DataFrame, number: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """``slice, rows, total, mixed``: the digest of each slice of ``df``, over all or the given columns."""
    values = [F.col(quote_column(c)) for c in columns or df.columns]
    hashed = df.select(number.alias(SLICE), row_hash(values, 1).alias("one"), row_hash(values, 2).alias("two"))
    return hashed.groupBy(SLICE).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("one").cast("decimal(20,0)")).alias("total"),
        F.bit_xor("two").alias("mixed"))


def differing_slices(source: DataFrame, target: DataFrame) -> list[int]:
    """The slices whose digests are not the same, those of one side only included."""
    theirs = target.select(SLICE, *[F.col(c).alias(f"their_{c}") for c in _DIGEST])
    same = F.lit(True)
    for c in _DIGEST:
        same &= F.col(c).eqNullSafe(F.col(f"their_{c}"))
    rows = source.join(theirs, SLICE, "full").where(~same).select(SLICE)
    return sorted(r[0] for r in rows.collect())


def copy_verified(
    spark: SparkSession,
    read: Callable[[], DataFrame],
    number: Callable[[DataFrame], Column],
    path: str,
    *,
    rounds: int = 5,
) -> dict:
    """Copy what ``read`` returns to ``path``, one folder a slice, until source and copy agree.

    ``read`` is called anew for each pass, so a source that changes is seen; ``number`` gives the slice of
    each row (not NULL), as :func:`slice_number` does. Returns the number of ``rounds`` and the ``repaired``
    slices. Raises :class:`TransferError` if they still differ after ``rounds`` comparisons.
    """
    source = read()
    if SLICE in (c.lower() for c in source.columns):
        raise ValueError(f"column name is reserved: {SLICE}")
    schema = source.schema
    _write(source.withColumn(SLICE, number(source)), path, "error")
    repaired: set[int] = set()
    for turn in range(1, rounds + 1):
        source = read()
        copy = _with_slices(spark, path, schema)
        wrong = differing_slices(
            slice_digests(source, number(source)), slice_digests(copy, F.col(SLICE), schema.names))
        if not wrong:
            return {"rounds": turn, "repaired": sorted(repaired)}
        repaired.update(wrong)
        for n in wrong:  # folders of slices that have become empty would stay
            delete_path(spark, f"{path.rstrip('/')}/{SLICE}={n}")
        source = read()
        _write(source.withColumn(SLICE, number(source)).where(F.col(SLICE).isin(wrong)), path, "append")
    raise TransferError(f"source and copy still differ after {rounds} comparisons")


def read_copy(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a copy, without their slices."""
    return _with_slices(spark, path, schema).drop(SLICE)


def _with_slices(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(SLICE, T.IntegerType())])).parquet(path)


def _write(rows: DataFrame, path: str, mode: str) -> None:
    """One folder a slice."""
    rows.write.mode(mode).partitionBy(SLICE).parquet(path)
