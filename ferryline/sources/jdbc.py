"""Sliced reads of a warehouse table or query over JDBC.

Each slice is one Spark partition with its own statement, so projection, the
user's condition and the slice predicate all run in the warehouse. The slices
are separate statements: reads of a table that changes meanwhile are not one
snapshot, so bound growing tables with an incremental condition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ferryline.errors import NotATableError
from ferryline.functions.names import qualified_name, quote_column, quote_literal
from ferryline.operators import slices
from ferryline.options import Connection

SLICINGS = ("modulo", "system", "range")


def read_table(
    spark: SparkSession,
    connection: Connection,
    table: str,
    *,
    schema: str | None = None,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    slice_key: str | Sequence[str] | None = None,
    num_slices: int = 1,
    slicing: str = "modulo",
) -> DataFrame:
    """Read ``table`` in ``num_slices`` partitions.

    ``slicing`` is ``modulo`` (any integer key), ``system`` (a locality column of
    the warehouse) or ``range`` (equal ranges between the key's bounds, which
    are fetched once). A modulo slice is as large as its largest key, so pick one
    that spreads, or name several columns to split the rows of a hot key. Without a
    key the connection's locality column is used; several slices need one of them.
    """
    if slicing not in SLICINGS:
        raise ValueError(f"slicing must be one of {SLICINGS}")
    slices.check_count(num_slices)
    if num_slices > 1 and slice_key is None:
        if connection.locality_column is None or slicing == "range":
            raise ValueError("several slices need a slice_key or the connection's locality_column")
        slice_key, slicing = connection.locality_column, "system"
    if slicing != "modulo" and slice_key is not None and not isinstance(slice_key, str):
        raise ValueError(f"slicing={slicing!r} takes a single key, not {tuple(slice_key)}")
    name = qualified_name(table, schema)
    reader = {**connection.properties(), "dbtable": name}
    if num_slices == 1:
        predicates = ["1=1"]
    elif slicing == "range":
        lo, hi = _bounds(spark, connection, name, slice_key, where)
        predicates = slices.range_predicates(slice_key, lo, hi, num_slices)
    else:
        predicates = slices.modulo_predicates(
            slice_key, num_slices, system_key=slicing == "system"
        )
    df = _read_predicates(spark, reader, slices.and_condition(predicates, where))
    return df.select(*[quote_column(c) for c in columns]) if columns else df


def read_query(
    spark: SparkSession,
    connection: Connection,
    sql: str,
    *,
    split_by: str | None = None,
    num_slices: int = 1,
) -> DataFrame:
    """Read the result of a free-form query, in ranges of ``split_by`` if given."""
    if num_slices == 1:
        return _load(spark, {**connection.properties(), "query": sql})
    if split_by is None:
        raise ValueError("a query read in several slices needs a split column")
    derived = f"({sql}) q"
    lo, hi = _bounds(spark, connection, derived, split_by, None)
    predicates = slices.range_predicates(split_by, lo, hi, num_slices)
    return _read_predicates(
        spark, {**connection.properties(), "dbtable": derived}, predicates
    )


def object_type(
    spark: SparkSession, connection: Connection, table: str, schema: str | None = None
) -> str:
    """The catalog's type of an object, upper case."""
    sql = connection.catalog_query.format(
        name=quote_literal(table),
        schema=quote_literal(schema) if schema else "CURRENT_SCHEMA",
    )
    row = _load(spark, {**connection.properties(), "query": sql}).first()
    if row is None:
        raise NotATableError(
            f"no catalog entry for {qualified_name(table, schema)}; "
            "check the letter case of the schema and table names"
        )
    return str(row[0]).strip().upper()


def _bounds(spark, connection, relation: str, key: str, where: str | None):
    """Smallest and largest key, computed by the warehouse."""
    col = slices.quote_identifier(key)
    sql = f"SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {relation}"
    if where is not None:
        sql += f" WHERE ( {where} )"
    row = _load(spark, {**connection.properties(), "query": sql}).first()
    if any(isinstance(v, bool) for v in row):
        raise ValueError(f"boolean column {key!r} cannot be a split column")
    return row[0], row[1]


def _load(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def _read_predicates(spark: SparkSession, options: dict[str, str], predicates) -> DataFrame:
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(
        options["url"], options["dbtable"], predicates=predicates, properties=rest
    )
