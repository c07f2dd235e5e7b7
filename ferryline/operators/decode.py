"""Delimited text to typed rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions import codec
from ferryline.functions import types as ft
from ferryline.functions.types import FieldType
from ferryline.functions.names import quote_column
from ferryline.operators.rules import (
    REJECT_COLUMN, REJECT_REASON, Rule, first_failure, named_failure,
)
from ferryline.options import LoadOptions

RAW = "_raw"
_FIELDS, _TEXTS, _MARKED = "_fields", "_texts", "_marked"
_RULE = "_rule"


def decode(
    lines: DataFrame,
    schema: T.StructType,
    opts: LoadOptions | None = None,
    *,
    line: str = "value",
    keep: Sequence[str] = (),
    observation: Observation | None = None,
) -> DataFrame:
    """Bind the fields of each line to ``schema`` by position and parse them strictly.

    Returns ``keep`` columns, the typed columns, ``_raw`` and, for lines that
    must not be loaded, ``_reject_column`` and ``_reject_reason`` (first failing
    rule). All steps are projections without a shuffle; they are kept apart so
    that each field is split, unescaped and cast once.

    The numbers of rows read and rejected are observed on the way. That also
    keeps the optimizer from pushing a filter on the outcome below the
    projections, where it would repeat all of their work.
    """
    opts = opts or LoadOptions()
    reserved = {RAW, REJECT_COLUMN, REJECT_REASON} & set(schema.names)
    if reserved:
        raise ValueError(f"column names are reserved: {sorted(reserved)}")
    types = [ft.field_type(f) for f in schema.fields]
    keep = list(keep)
    delim, sep = opts.field_delim, opts.record_sep
    values = [f"_value_{k}" for k in range(len(types))]
    raw, marked = F.col(RAW), F.col(_MARKED)

    split = lines.select(
        *keep, F.col(line).alias(RAW), codec.is_marked(F.col(line), delim, sep).alias(_MARKED)
    ).select("*", codec.raw_fields(raw, marked, delim, sep).alias(_FIELDS))
    rules = [
        Rule(None, "invalid_utf8", ~F.is_valid_utf8(raw)),
        Rule(None, "dangling_escape", codec.dangling_escape(raw)),
        Rule(None, "line_end", codec.bare_line_end(raw)),
        Rule(None, "field_count", F.size(_FIELDS) != len(types)),
    ]
    row = split.select(
        "*",
        codec.text_fields(raw, F.col(_FIELDS), marked, delim, sep).alias(_TEXTS),
        first_failure(rules).alias(_RULE),
    )

    for start in range(0, len(types), codec.FIELDS_PER_METHOD):
        group = range(start, min(start + codec.FIELDS_PER_METHOD, len(types)))
        number = F.col(_RULE)
        row = row.select(
            *keep, RAW, _MARKED, _FIELDS, _TEXTS, *values[:start],
            (codec.compiled_apart(number) if start else number).alias(_RULE),
            *[
                codec.parse_field(_text(k), _is_null(k, types[k], opts), types[k], opts)
                .alias(values[k])
                for k in group
            ],
        )
        found = [
            rule for k in group
            for rule in _field_rules(schema.fields[k], types[k], k, F.col(values[k]), opts)
        ]
        if found:
            row = row.withColumn(_RULE, F.coalesce(number, first_failure(found, len(rules))))
            rules += found

    checked = row.select(
        *keep,
        *[F.col(v).alias(n) for v, n in zip(values, schema.names)],
        RAW,
        *named_failure(F.col(_RULE), rules),
    )
    return checked.observe(
        observation or f"decode-{uuid.uuid4().hex}",
        F.count(F.lit(1)).alias("read"),
        F.count(REJECT_REASON).alias("rejected"),
    )


def _text(k: int) -> Column:
    return F.get(_TEXTS, F.lit(k))


def _is_null(k: int, ftype: FieldType, opts: LoadOptions) -> Column:
    return codec.is_null_field(F.get(_FIELDS, F.lit(k)), F.col(_MARKED), ftype, opts)


def _field_rules(
    field: T.StructField, ftype: FieldType, k: int, value: Column, opts: LoadOptions
) -> Iterator[Rule]:
    is_null = _is_null(k, ftype, opts)
    if not field.nullable:
        yield Rule(field.name, "null_value", is_null)
    if ftype.kind == ft.STRING and not opts.ctrl_chars:
        control = codec.control_class(opts.field_delim)
        yield Rule(field.name, "control_character", _text(k).rlike(control))
    bad = codec.badly_formed(_text(k), value, is_null, ftype)
    if bad is not None:
        yield Rule(field.name, f"invalid_{ftype.kind}", bad)


def accepted(decoded: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The rows that may be loaded, typed columns only."""
    return decoded.where(F.col(REJECT_REASON).isNull()).select(
        *map(quote_column, [*keep, *schema.names])
    )


def rejected(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The raw lines that failed, with the column and the reason.

    Bytes that are no UTF-8 are shown as U+FFFD, so that rejects can be stored as text.
    """
    return decoded.where(F.col(REJECT_REASON).isNotNull()).select(
        *keep,
        F.make_valid_utf8(RAW).alias("raw"),
        F.col(REJECT_COLUMN).alias("column"),
        F.col(REJECT_REASON).alias("reason"),
    )
