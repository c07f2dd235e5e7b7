"""Writing to warehouse tables over JDBC.

Rows go to a staging table first, in parallel, and reach the target in one
server-side statement. A Spark task that is run again after a lost executor may
have committed before; each staged row carries its number, so the statement
reads every row once however often it was sent.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext, suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.functions.names import qualified_name, quote_identifier
from ferryline.operators.update import one_row_per_key
from ferryline.options import Connection
from ferryline.shared import stored as stored_once

#: Lowest isolation the warehouse knows; Spark's own default is READ_UNCOMMITTED.
ISOLATION = "READ_COMMITTED"
ROW_NUMBER, COPY = "ferryline_row", "ferryline_copy"

# JDBC options that are Spark's own; all others belong to the driver.
SPARK_OPTIONS = frozenset(
    "url dbtable query preparequery driver partitioncolumn lowerbound upperbound numpartitions "
    "querytimeout fetchsize batchsize isolationlevel sessioninitstatement truncate "
    "cascadetruncate createtableoptions createtablecolumntypes customschema "
    "pushdownpredicate pushdownaggregate pushdownlimit pushdownoffset pushdowntablesample "
    "keytab principal refreshkrb5config connectionprovider prefertimestampntz hint".split()
)


def append_table(
    df: DataFrame,
    connection: Connection,
    table: str,
    *,
    schema: str | None = None,
    max_connections: int = 32,
    batch_size: int = 1000,
    stored: bool = False,
) -> None:
    """Append ``df``: all rows or none, each exactly once.

    ``stored`` says that ``df`` already reads a stable table; otherwise it is
    stored first, since row numbers must not change between task attempts.
    """
    names, target = _column_list(df.columns), qualified_name(table, schema)
    once = nullcontext(df) if stored else stored_once(df, "append")
    with (once as rows,
          _staging(rows, connection, target, schema, max_connections, batch_size) as source):
        execute(df.sparkSession, connection, [
            f"INSERT INTO {target} ({names}) SELECT {names} FROM ({source}) s"
        ])


def update_table(
    changes: DataFrame,
    connection: Connection,
    table: str,
    keys: Sequence[str],
    *,
    schema: str | None = None,
    order_by: Sequence[str] = (),
    num_writers: int = 1,
    max_connections: int = 32,
    batch_size: int = 1000,
) -> None:
    """Update matching rows of ``table``; never inserts.

    The target has exactly one writer, the MERGE statement; staging is parallel.
    Repeated keys are handled as in :func:`one_row_per_key`.
    """
    if num_writers != 1:
        raise ValueError("update mode works with exactly one writer on the target")
    values = [c for c in changes.columns if c not in keys and c not in order_by]
    if not values:
        raise ValueError("no columns to update besides the keys")
    target = qualified_name(table, schema)
    match = " AND ".join(f"t.{q} = s.{q}" for q in map(quote_identifier, keys))
    assign = ", ".join(f"{q} = s.{q}" for q in map(quote_identifier, values))
    with (stored_once(one_row_per_key(changes, keys, order_by), "update") as rows,
          _staging(rows, connection, target, schema, max_connections, batch_size) as source):
        execute(changes.sparkSession, connection, [
            f"MERGE INTO {target} t USING ({source}) s "
            f"ON {match} WHEN MATCHED THEN UPDATE SET {assign}"
        ])


@contextmanager
def _staging(
    rows: DataFrame, connection: Connection, target: str, schema, max_connections: int,
    batch_size: int,
) -> Iterator[str]:
    """Send the numbered rows to a fresh table; yields the query that reads them.

    The warehouse makes that table from the target, so its columns have the target's
    types, and repeats are told by the row number alone, whatever the columns hold.
    """
    table = qualified_name(f"ferryline_{uuid.uuid4().hex[:16]}", schema)
    names, number, copy = _column_list(rows.columns), *map(quote_identifier, (ROW_NUMBER, COPY))
    numbered = rows.withColumn(ROW_NUMBER, F.monotonically_increasing_id())
    options = {
        **connection.properties(),
        "dbtable": table,
        "numPartitions": str(max_connections),
        "batchsize": str(batch_size),
        "isolationLevel": ISOLATION,
    }
    try:
        execute(rows.sparkSession, connection, [
            f"CREATE TABLE {table} AS "
            f"SELECT {names}, CAST(0 AS BIGINT) AS {number} FROM {target} WHERE 1 = 0"
        ])
        _save(numbered, options)
        yield (f"SELECT {names} FROM (SELECT {names}, ROW_NUMBER() OVER "
               f"(PARTITION BY {number} ORDER BY {number}) AS {copy} FROM {table}) d WHERE {copy} = 1")
    finally:
        # A failed clean-up must not hide the error that led here.
        with suppress(Exception):
            execute(rows.sparkSession, connection, [f"DROP TABLE {table}"])


def _save(rows: DataFrame, options: dict[str, str]) -> None:
    rows.write.format("jdbc").options(**options).mode("append").save()


def _column_list(columns: Sequence[str]) -> str:
    return ", ".join(quote_identifier(c) for c in columns)


def execute(spark: SparkSession, connection: Connection, statements: Sequence[str]) -> None:
    """Run statements in the warehouse as one transaction."""
    jvm = spark._jvm
    options = connection.properties()
    props = jvm.java.util.Properties()
    for key, value in options.items():
        if key.lower() not in SPARK_OPTIONS:
            props.setProperty(key, str(value))
    if connection.driver:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(
            connection.driver
        )
    conn = jvm.java.sql.DriverManager.getConnection(connection.url, props)
    try:
        conn.setTransactionIsolation(jvm.java.sql.Connection.TRANSACTION_READ_COMMITTED)
        conn.setAutoCommit(False)
        statement = conn.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()
