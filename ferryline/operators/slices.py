"""Disjoint, complete slices of a table.

Two forms of the same split: a slice number per row for DataFrames, and one
predicate per slice for JDBC reads. Keys chosen by users may be negative or
NULL; negative keys are folded and NULL keys belong to slice 0, so that the
slices always add up to the table.
"""

from __future__ import annotations

import datetime
import os
from collections import Counter
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.names import quote_column, quote_identifier, quote_literal


def slice_number(df: DataFrame, key: str | Sequence[str], n: int) -> Column:
    """Slice of each row, 0 to n-1.

    A single integer key is taken modulo ``n``; any other key, or several
    columns (which spreads the rows of one hot key), is hashed first.
    """
    check_count(n)
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) == 1 and isinstance(
        df.schema[keys[0]].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    ):
        return F.coalesce(F.pmod(F.col(keys[0]), F.lit(n)), F.lit(0)).cast("int")
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def slice_df(df: DataFrame, key: str | Sequence[str], n: int, name: str = "slice") -> DataFrame:
    """Add the slice number; no rows move."""
    return df.withColumn(name, slice_number(df, key, n))


def exact_literal(value, kind: T.DataType | None = None) -> Column:
    """A literal that no process time zone can shift.

    ``kind`` is the type of the column it is compared with. An aware datetime is an
    instant. A naive one goes through its text: as it stands for ``timestamp_ntz`` (and
    without a ``kind``), in the session's zone for ``timestamp``.
    """
    if not isinstance(value, datetime.datetime):
        return F.lit(value)
    if value.tzinfo is not None:
        if isinstance(kind, T.TimestampNTZType):
            raise ValueError("a timestamp_ntz column takes datetimes without a zone")
        since = value - datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
        return F.timestamp_micros(F.lit(since // datetime.timedelta(microseconds=1)))
    as_type = "timestamp" if isinstance(kind, T.TimestampType) else "timestamp_ntz"
    return F.lit(value.isoformat(sep=" ")).cast(as_type)


def exact_row(df: DataFrame, *values: Column) -> tuple:
    """The values of a one-row aggregate; instants of ``timestamp`` come as aware UTC."""
    row = df.agg(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    instants = [isinstance(f.dataType, T.TimestampType) for f in row.schema]
    fetched = row.select(*[
        F.unix_micros(f"v{i}") if instant else F.col(f"v{i}") for i, instant in enumerate(instants)
    ]).first()
    epoch = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
    return tuple(
        epoch + datetime.timedelta(microseconds=v) if instant and v is not None else v
        for v, instant in zip(fetched, instants)
    )


def range_slice_number(col: Column, lo, hi, n: int, kind: T.DataType | None = None) -> Column:
    """Slice of each row among ``n`` equal ranges of ``lo``..``hi``; NULL is slice 0.

    The same cuts as :func:`range_predicates`, compared by bisection. Bounds of a
    ``timestamp`` column should be aware (:func:`exact_row`); ``kind`` is its type.
    """
    if isinstance(kind, T.StringType):
        check_text_order(kind)
    cuts = range_cuts(lo, hi, n)
    return _located(col, [None, *cuts[1:]], kind)


def _located(col: Column, lower: list, kind: T.DataType | None, strictly: bool = False) -> Column:
    """Number of the last range whose lower end is at or below ``col``; the first range is open."""

    def locate(first: int, last: int) -> Column:
        if first == last:
            return F.lit(first)
        middle = (first + last + 1) // 2
        cut = exact_literal(lower[middle], kind)
        return F.when(col > cut if strictly else col >= cut, locate(middle, last)).otherwise(
            locate(first, middle - 1)
        )

    return locate(0, len(lower) - 1)


def range_cuts(lo, hi, n: int) -> list:
    """Lower ends of ``n`` ranges; fewer when the values are too close together.

    Text is cut as numbers, see :func:`text_cuts`.
    """
    check_count(n)
    if lo is None or hi is None:
        return [lo]
    if isinstance(lo, str):
        return text_cuts(lo, hi, n)
    if isinstance(lo, (int, float, Decimal)):
        width = Decimal(str(hi)) - Decimal(str(lo))
        cuts = [Decimal(str(lo)) + width * i / n for i in range(n)]
        if isinstance(lo, int):
            cuts = [int(c.to_integral_value(rounding="ROUND_CEILING")) for c in cuts]
    elif isinstance(lo, (datetime.date, datetime.datetime)):
        cuts = [lo + (hi - lo) * i / n for i in range(n)]
    else:
        raise ValueError(f"cannot cut a range of {type(lo).__name__} values")
    return sorted(set(cuts))


# The code points, without the surrogates, which are no characters.
_SURROGATES, _SURROGATE_COUNT = 0xD800, 0x800
_DIGITS = 0x110000 - _SURROGATE_COUNT
#: Characters after the common prefix that decide about cuts of text.
TEXT_DIGITS = 8


def text_number(text: str, digits: int = TEXT_DIGITS) -> int:
    """The first characters of ``text`` as a number that orders texts as their UTF-8 bytes do."""
    number = 0
    for char in text[:digits].ljust(digits, "\0"):
        point = ord(char)
        number = number * _DIGITS + (point if point < _SURROGATES else point - _SURROGATE_COUNT)
    return number


def number_text(number: int, digits: int = TEXT_DIGITS) -> str:
    """The text of a number, without the null characters at its end."""
    chars = []
    for _ in range(digits):
        number, digit = divmod(number, _DIGITS)
        chars.append(chr(digit if digit < _SURROGATES else digit + _SURROGATE_COUNT))
    return "".join(reversed(chars)).rstrip("\0")


def text_cuts(lo: str, hi: str, n: int) -> list[str]:
    """Lower ends of ``n`` ranges of text, equally far apart as numbers after the common prefix.

    Of each exact cut only as many characters are kept as tell it from the cut before it.
    """
    if hi < lo:
        raise ValueError("the bounds are not in order")
    prefix = os.path.commonprefix([lo, hi])
    begin, end = (text_number(x[len(prefix):]) for x in (lo, hi))
    cuts = [lo]
    for i in range(1, n):
        exact = number_text(begin + (end - begin) * i // n)
        before = cuts[-1][len(prefix):] if i > 1 else lo[len(prefix):]
        short = next((exact[:k] for k in range(1, len(exact)) if exact[:k] > before), exact)
        cut = prefix + short
        if cut > cuts[-1] and "\0" not in cut:
            cuts.append(cut)
    return cuts


def check_text_order(kind: T.StringType) -> None:
    """Cuts of text are in the order of UTF-8 bytes; another collation may order them otherwise."""
    if not kind.isUTF8BinaryCollation():
        raise ValueError(f"a column with collation {kind.collation} cannot be cut by ranges of text")


# ----------------------------------------------------------- slices of equal size

def quantile_cuts(df: DataFrame, col: str, n: int, accuracy: int | None = None) -> list:
    """The ``n - 1`` quantiles of a split column, in order; a frequent value stands there repeatedly.

    One pass: every task sketches its values, and the sketches are merged. A slice then
    differs from the mean by at most two times ``1 / accuracy`` of the rows (by default
    a sixteenth of a slice). NULLs are not counted; they belong to the first slice.
    """
    check_count(n)
    kind = df.schema[col].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"no quantiles of {kind.simpleString()} values; use ranges or a hash")
    if n == 1:
        return []
    key = F.col(quote_column(col))
    at = [i / n for i in range(1, n)]
    sketch = F.percentile_approx(key, at, accuracy or max(10_000, 32 * n))
    if isinstance(kind, T.TimestampType):
        (found,) = df.agg(F.transform(sketch, F.unix_micros)).first()
        epoch = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
        return [epoch + datetime.timedelta(microseconds=v) for v in found or []]
    (found,) = df.agg(sketch).first()
    return list(found or [])


def quantile_slice_number(
    df: DataFrame, col: str, cuts: Sequence, spread_by: Sequence[str] = ()
) -> Column:
    """Slice of each row between the cuts of :func:`quantile_cuts`; NULL is slice 0.

    A value that fills several slices stands among the cuts as often. Its rows are dealt over all slices
    it may belong to by a hash of ``spread_by``; without these columns they stay together in the last one.
    """
    value, kind = F.col(quote_column(col)), df.schema[col].dataType
    lower = [None, *cuts]
    last = _located(value, lower, kind)
    if not spread_by or len(set(cuts)) == len(cuts):
        return F.coalesce(last, F.lit(0)).cast("int")
    first = _located(value, lower, kind, strictly=True)
    dealt = first + F.pmod(F.xxhash64(*[F.col(quote_column(c)) for c in spread_by]), last - first + 1)
    return F.coalesce(F.when(value.isNull(), 0).otherwise(dealt), F.lit(0)).cast("int")


def quantile_predicates(key: str, cuts: Sequence, spread_by: str | None = None) -> list[str]:
    """One predicate per slice of :func:`quantile_cuts`.

    The rows of a value that stands among the cuts several times are dealt by the integer column
    ``spread_by``, if given. The predicates add up to the table, NULL keys included.
    """
    col = quote_identifier(key)
    counts = Counter(cuts)
    values = sorted(counts)
    if not values:
        return ["1=1"]
    out, below = [], f"({col} < {sql_literal(values[0])} OR {col} IS NULL)"
    for value, upper in zip(values, [*values[1:], None]):
        shares = counts[value] if spread_by else 1
        literal = sql_literal(value)
        up_to = "" if upper is None else f" AND {col} < {sql_literal(upper)}"
        out.append(below)
        for share in range(shares - 1):
            other = f"COALESCE(ABS(MOD({quote_identifier(spread_by)}, {shares})), 0)"
            out.append(f"{col} = {literal} AND {other} = {share}")
        if shares == 1:
            below = f"{col} >= {literal}{up_to}"
        else:
            below = f"({col} > {literal}{up_to} OR {col} = {literal} AND {other} = {shares - 1})"
    return [*out, below]


def bounds(df: DataFrame, col: str) -> DataFrame:
    """One row ``lo, hi`` of a split column; booleans have no usable bounds."""
    if isinstance(df.schema[col].dataType, T.BooleanType):
        raise ValueError(f"boolean column {col!r} cannot be a split column")
    return df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))


# ------------------------------------------------------- predicates for JDBC

def modulo_predicates(
    key: str | Sequence[str], n: int, *, system_key: bool = False
) -> list[str]:
    """One predicate per slice.

    Several integer columns are added up before the modulo, so that the rows of
    one hot key spread by the others. ``system_key`` marks a locality column of
    the warehouse, named as is, which is never NULL and never negative.
    """
    check_count(n)
    if system_key:
        return [f"MOD({key}, {n}) = {i}" for i in range(n)]
    keys = [key] if isinstance(key, str) else list(key)
    parts = [f"COALESCE(ABS(MOD({quote_identifier(k)}, {n})), 0)" for k in keys]
    number = parts[0] if len(parts) == 1 else f"MOD({' + '.join(parts)}, {n})"
    return [f"{number} = {i}" for i in range(n)]


def range_predicates(key: str, lo, hi, n: int, *, binary_text: bool = False) -> list[str]:
    """Ranges over the key; the outer ones are open, so no row is left out.

    Cuts of text are in the order of UTF-8 bytes. A warehouse that compares the column otherwise would
    read rows twice or not at all, so text keys need ``binary_text``: the caller's word that it does not.
    """
    if isinstance(lo, str) and not binary_text:
        raise ValueError("ranges of text need a column that is compared by bytes; say so by binary_text")
    col = quote_identifier(key)
    cuts = [sql_literal(c) for c in range_cuts(lo, hi, n)]
    if len(cuts) == 1:
        return ["1=1"]
    out = [f"({col} < {cuts[1]} OR {col} IS NULL)"]
    out += [f"{col} >= {a} AND {col} < {b}" for a, b in zip(cuts[1:], cuts[2:])]
    return [*out, f"{col} >= {cuts[-1]}"]


def and_condition(predicates: list[str], where: str | None) -> list[str]:
    """Add the user's condition, in parentheses so that an OR stays inside it."""
    if where is None:
        return predicates
    return [f"{p} AND ( {where} )" for p in predicates]


def sql_literal(value) -> str:
    """A bound as it stands in a predicate."""
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP {quote_literal(value.isoformat(sep=' '))}"
    if isinstance(value, datetime.date):
        return f"DATE {quote_literal(value.isoformat())}"
    return quote_literal(value) if isinstance(value, str) else str(value)


def check_count(n: int) -> None:
    if n < 1:
        raise ValueError("the number of slices must be at least 1")
