"""Mapping of Spark fields to the warehouse types that the text form knows."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

#: Metadata key that marks a string field as carrying a TIME of day.
TIME_METADATA = "ferryline.time"
_CHAR_VARCHAR_METADATA = "__CHAR_VARCHAR_TYPE_STRING"

STRING, BOOLEAN, INTEGER, DECIMAL, DOUBLE, DATE, TIMESTAMP, TIME = (
    "string", "boolean", "integer", "decimal", "double", "date", "timestamp", "time",
)


@dataclass(frozen=True)
class FieldType:
    """What the codec needs to know about one column."""

    kind: str
    sql: str                  # Spark SQL name used in casts
    width: int | None = None  # declared width of CHAR(n) / VARCHAR(n)
    padded: bool = False      # CHAR(n): blank-padded to ``width``


def time_field(name: str, nullable: bool = True) -> T.StructField:
    """A ``HH:mm:ss`` column, carried as a checked string."""
    return T.StructField(name, T.StringType(), nullable, {TIME_METADATA: True})


def field_type(field: T.StructField) -> FieldType:
    """Classify ``field``; binary and nested types have no text form."""
    dtype = field.dataType
    if isinstance(dtype, (T.CharType, T.VarcharType)):
        return FieldType(STRING, "string", dtype.length, isinstance(dtype, T.CharType))
    if isinstance(dtype, T.StringType):
        if field.metadata.get(TIME_METADATA):
            return FieldType(TIME, "string")
        declared = re.fullmatch(
            r"(char|varchar)\((\d+)\)", field.metadata.get(_CHAR_VARCHAR_METADATA, "")
        )
        if declared:
            return FieldType(STRING, "string", int(declared[2]), declared[1] == "char")
        return FieldType(STRING, "string")
    if isinstance(dtype, T.BooleanType):
        return FieldType(BOOLEAN, "boolean")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return FieldType(INTEGER, dtype.simpleString())
    if isinstance(dtype, T.DecimalType):
        return FieldType(DECIMAL, dtype.simpleString())
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return FieldType(DOUBLE, dtype.simpleString())
    if isinstance(dtype, T.DateType):
        return FieldType(DATE, "date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return FieldType(TIMESTAMP, dtype.simpleString())
    raise ValueError(
        f"column {field.name!r}: type {dtype.simpleString()} has no delimited text form"
    )
