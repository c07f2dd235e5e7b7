"""One description for a table, wherever it lives."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ferryline.errors import NotATableError
from ferryline.sources import catalog, jdbc
from ferryline.options import Connection

# Object types that count as real tables.
TABLE_TYPES = ("TABLE", "BASE TABLE", "MANAGED", "EXTERNAL")

TABLES_ONLY = (
    "direct transfers work with real tables only; views and other objects are not supported"
)


@dataclass(frozen=True)
class Table:
    """A warehouse table (with ``connection``) or a Spark catalog table (without)."""

    name: str
    schema: str | None = None
    connection: Connection | None = None
    columns: tuple[str, ...] | None = None
    where: str | None = None
    slice_key: str | tuple[str, ...] | None = None
    num_slices: int = 1
    slicing: str = "modulo"

    def read(self, spark: SparkSession) -> DataFrame:
        if self.connection is None:
            if self.num_slices != 1 or self.slice_key is not None or self.slicing != "modulo":
                raise ValueError("Spark plans the partitions of a catalog table; slices are for JDBC")
            df = spark.table(catalog.spark_name(self.name, self.schema))
            return catalog.select_rows(df, self.columns, self.where)
        return jdbc.read_table(
            spark, self.connection, self.name, schema=self.schema, columns=self.columns,
            where=self.where, slice_key=self.slice_key, num_slices=self.num_slices,
            slicing=self.slicing,
        )

    def object_type(self, spark: SparkSession) -> str:
        if self.connection is None:
            return catalog.object_type(spark, self.name, self.schema)
        return jdbc.object_type(spark, self.connection, self.name, self.schema)

    def require_table(self, spark: SparkSession) -> None:
        if self.object_type(spark) not in TABLE_TYPES:
            raise NotATableError(f"{self.name}: {TABLES_ONLY}")

    def struct(self, spark: SparkSession) -> T.StructType:
        """All columns as the catalog declares them (names, types, widths)."""
        if self.connection is None:
            return spark.table(catalog.spark_name(self.name, self.schema)).schema
        return jdbc.read_table(spark, self.connection, self.name, schema=self.schema).schema
