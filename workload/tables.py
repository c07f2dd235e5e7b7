"""Input tables and the derived columns that several queries share.

The tables hold no NULLs, booleans, decimals or malformed text, so the queries
derive them by expression over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline import UnloadOptions
from ferryline.options import LoadOptions

#: For text with line ends: an escape before them and a record separator of its own.
ESCAPED_ENDS = UnloadOptions(newline_policy="escape", record_sep="\x1e", null_string="\\\\N")
ESCAPED_ENDS_IN = LoadOptions(record_sep="\x1e", null_string="\\\\N")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(name: str, alias: str | None = None):
    return F.col(name).cast("decimal(18,4)").alias(alias or name)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with decimals in place of doubles."""
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        *[money(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        "l_returnflag", "l_linestatus", "l_shipdate",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with a decimal price."""
    return read(spark, sf_dir, "orders").withColumn("o_totalprice", money("o_totalprice"))
