"""Typed rows to delimited text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.functions import codec
from ferryline.functions import types as ft
from ferryline.functions.names import quote_column
from ferryline.operators.rules import Rule, with_first_failure
from ferryline.options import UnloadOptions

VALUE = "value"

# Why a row can have no valid record.
LINE_END, RECORD_SEPARATOR, CONTROL = "line_end", "record_separator", "control_character"
TOO_LONG = "too_long"
REASONS = (LINE_END, RECORD_SEPARATOR, CONTROL, TOO_LONG)


def encode(
    df: DataFrame,
    opts: UnloadOptions | None = None,
    *,
    columns: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One text record per row, with the reason why a row has no valid record.

    Returns ``keep`` columns, ``value``, ``_reject_column`` and ``_reject_reason``.
    A narrow projection: no shuffle, and only the named columns are scanned.
    """
    opts = opts or UnloadOptions()
    names = list(columns) if columns else df.columns
    unknown = [c for c in (*opts.char_widths, *opts.time_columns) if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown} (char_widths, time_columns)")
    fields, rules = [], []
    for name in names:
        ftype = ft.field_type(df.schema[name])
        value = F.col(quote_column(name))
        if name in opts.time_columns and ftype.kind == ft.TIMESTAMP:
            ftype, value = ft.FieldType(ft.TIME, "string"), codec.time_text(value)
        if name in opts.char_widths:
            ftype = replace(ftype, width=opts.char_widths[name], padded=True)
        fields.append(codec.encode_field(value, ftype, opts))
        if ftype.kind == ft.STRING:
            rules += _text_rules(name, value, opts)
            if ftype.padded:  # blanks beyond the width carry nothing, other characters do
                rules.append(Rule(name, TOO_LONG, F.length(F.rtrim(value)) > ftype.width))
    line = codec.join_fields(fields, opts.field_delim)
    return with_first_failure(
        df, rules, [*(F.col(quote_column(k)) for k in keep), line.alias(VALUE)]
    )


def _text_rules(name, value, opts: UnloadOptions) -> list[Rule]:
    rules = []
    if opts.newline_policy == "reject":
        rules.append(Rule(name, LINE_END, value.contains("\n") | value.contains("\r")))
    if opts.record_sep != "\n":
        rules.append(Rule(name, RECORD_SEPARATOR, value.contains(opts.record_sep)))
    if not opts.ctrl_chars:
        control = codec.control_class(opts.field_delim)
        rules.append(Rule(name, CONTROL, value.rlike(control)))
    return rules


def can_reject(df: DataFrame, opts: UnloadOptions, columns: Sequence[str] | None = None) -> bool:
    """Whether any row could fail at all under these options."""
    names = columns or df.columns
    types = [ft.field_type(df.schema[n]) for n in names]
    if opts.char_widths or any(t.padded for t in types):
        return True
    has_text = any(t.kind == ft.STRING for t in types)
    return has_text and not (
        opts.ctrl_chars and opts.newline_policy == "space" and opts.record_sep == "\n"
    )
