"""Where loaded rows go."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ferryline.functions.names import spark_name
from ferryline.sinks import jdbc
from ferryline.sources.table import Table


@dataclass(frozen=True)
class Directory:
    """A directory of record files as a load target."""

    path: str
    fmt: str = "parquet"


def append(target: Table | Directory, rows: DataFrame, stored: bool = False, *,
           names: Sequence[str] | None = None, max_connections: int = 32,
           batch_size: int = 1000) -> None:
    """Append by position, all columns; ``stored`` as in :func:`jdbc.append_table`.

    ``names`` are the target's columns, where ``rows`` name theirs otherwise.
    """
    if names is not None:
        rows = rows.toDF(*names)
    if isinstance(target, Directory):
        rows.write.format(target.fmt).mode("append").save(target.path)
    elif target.connection is None:
        rows.write.insertInto(spark_name(target.name, target.schema))
    else:
        jdbc.append_table(
            rows, target.connection, target.name, schema=target.schema, stored=stored,
            max_connections=max_connections, batch_size=batch_size,
        )
