"""How the operators of this package carry their input rows.

The input row travels as one struct ``doc``, so that helper columns never meet
a column of the caller, and every row gets a number ``uid`` that is fixed by
writing the rows once. Repeated rows therefore stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.shared import materialize


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and backticks included."""
    return F.col(quoted(name))


def as_doc(df: DataFrame, only: list[str] | None = None) -> Column:
    """The input row, or the named columns of it, as one struct."""
    return F.struct(*[col(c) for c in (only if only is not None else df.columns)]).alias("doc")


def numbered(df: DataFrame, *columns: Column, only: list[str] | None = None,
             purpose: str = "rows") -> DataFrame:
    """Store ``uid``, ``doc`` (none if ``only`` is empty) and the computed columns once."""
    doc = [] if only == [] else [as_doc(df, only)]
    return materialize(
        df.select(F.monotonically_increasing_id().alias("uid"), *doc, *columns), purpose, "zstd")


def unpacked(columns: list[str], changed: dict[str, Column] | None = None) -> list[Column]:
    """The columns of ``doc`` at top level again, some of them replaced."""
    new = {k.lower(): v for k, v in (changed or {}).items()}
    return [new.get(c.lower(), F.col("doc").getField(c)).alias(c) for c in columns]


def positions(df: DataFrame, by: list[str], order: list[str], purpose: str = "ranked") -> DataFrame:
    """``df`` with ``pos``, the place from 0 within the rows of equal ``by``, and ``group_rows``, their number.

    Rows are dealt into sorted ranges and stored; counts of each range give the offsets, so
    no task holds a group as a whole and a hot group is spread over many ranges. NULL comes
    first, NULL keys are one group; rows that tie in ``order`` come in any order.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*by, *order]
    spread = materialize(
        df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .withColumn("place", F.monotonically_increasing_id()), purpose, "zstd"
    ).withColumn("part", F.shiftright("place", 33))
    spans = spread.groupBy("part", *by).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    group = Window.partitionBy(*by)
    before = F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = spans.select(
        F.col("part").alias("o_part"), *[F.col(c).alias(f"o_{c}") for c in by],
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(group).alias("group_rows"))
    same = F.col("part") == F.col("o_part")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"o_{c}"))
    return spread.join(offsets, same).select(
        *df.columns, (F.col("place") + F.col("shift")).alias("pos"), "group_rows")
