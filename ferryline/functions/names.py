"""Identifier quoting."""

from __future__ import annotations


def quote_identifier(name: str | None) -> str | None:
    """ANSI quoting for the warehouse: wrapped in ``"``, inner quotes doubled."""
    return None if name is None else '"' + name.replace('"', '""') + '"'


def qualified_name(table: str, schema: str | None = None) -> str:
    """Quoted table name; an empty schema is the current schema."""
    if schema:
        return f"{quote_identifier(schema)}.{quote_identifier(table)}"
    return quote_identifier(table)


def quote_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def quote_column(name: str) -> str:
    """Backtick-quoted name of one top-level Spark column; dots are part of it."""
    return "`" + name.replace("`", "``") + "`"


def spark_name(table: str, schema: str | None = None) -> str:
    """Backtick-quoted name for the Spark catalog; dots in ``table`` separate parts."""
    parts = ([schema] if schema else []) + table.split(".")
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)
