"""Tables of the Spark catalog."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.errors import NotATableError
from ferryline.functions.names import quote_column, spark_name


def object_type(spark: SparkSession, table: str, schema: str | None = None) -> str:
    """``MANAGED``, ``EXTERNAL``, ``VIEW`` or ``TEMPORARY``."""
    name = spark_name(table, schema)
    try:
        return spark.catalog.getTable(name).tableType
    except AnalysisException as exc:
        raise NotATableError(
            f"no catalog entry for {name}; check the schema and table names"
        ) from exc


def select_rows(
    df: DataFrame, columns=None, where: str | Column | None = None
) -> DataFrame:
    """Condition, then projection in the given order; nothing given keeps all.

    Both reach the scan: Catalyst pushes the condition and prunes the columns.
    """
    if where is not None:
        df = df.where(F.expr(f"({where})") if isinstance(where, str) else where)
    return df.select(*[quote_column(c) for c in columns]) if columns else df


def query_rows(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A free-form query; ``{name}`` in the text stands for a DataFrame."""
    return spark.sql(sql, **tables)
