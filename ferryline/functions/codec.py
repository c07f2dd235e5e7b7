"""The escaped-text codec as Column expressions.

Everything here stays inside generated JVM code; there is no Python per row.
Plain byte replacement is used for escaping, and the costlier regular
expressions run only on values that contain the escape character at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferryline.functions import types as ft
from ferryline.functions.types import FieldType
from ferryline.options import ESCAPE

_REGEX_META = set(".$|()[{^?*+\\")

# The accepted text of each type, beyond Spark's own canonical form.
STRICT_TEXT = {
    ft.INTEGER: r"\A[+-]?[0-9]+\z",
    ft.DOUBLE: r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z",
    ft.DATE: r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z",
    ft.TIMESTAMP: r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?\z",
    ft.TIME: r"\A(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z",
}

# Odd run of backslashes at the end of a line.
_DANGLING_ESCAPE = r"(?<!\\)(?:\\\\)*+\\\z"


def _code_point(char: str) -> str:
    return f"\\x{{{ord(char):x}}}"


def control_class(delim: str) -> str:
    """Control characters other than the delimiter and the line ends.

    Those three have their own rules: a delimiter is always escaped, and line
    ends follow the newline policy.
    """
    return "[" + "".join(
        _code_point(chr(c)) for c in range(0x20) if chr(c) not in (delim, "\r", "\n")
    ) + "]"


# ---------------------------------------------------------------- encode

def escape_text(text: Column, delim: str, newline_policy: str = "reject") -> Column:
    """Backslash before every delimiter and backslash, then the newline policy."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    text = F.replace(text, F.lit(delim), F.lit(ESCAPE + delim))
    if newline_policy == "space":
        for end in "\r\n":
            text = F.replace(text, F.lit(end), F.lit(" "))
    elif newline_policy in ("escape", "continue"):
        for end in "\r\n":
            text = F.replace(text, F.lit(end), F.lit(ESCAPE + end))
    return text


def bool_text(value: Column, words: tuple[str, str]) -> Column:
    return F.when(value, words[0]).when(~value, words[1])


def time_text(value: Column) -> Column:
    return F.date_format(value, "HH:mm:ss")


def char_pad(value: Column, width: int) -> Column:
    """Blank-pad a CHAR(width) value; longer values are cut to the width."""
    return F.rpad(value, width, " ")


def plain_text(value: Column, ftype: FieldType, bool_words: tuple[str, str]) -> Column:
    """Text of a value before escaping: full decimal scale, seconds always there."""
    if ftype.kind == ft.BOOLEAN:
        return bool_text(value, bool_words)
    if ftype.padded:
        return char_pad(value, ftype.width)
    return value if ftype.sql == "string" else value.cast("string")


def encode_field(value: Column, ftype: FieldType, opts) -> Column:
    """One escaped, never-null field."""
    text = plain_text(value, ftype, opts.bool_words)
    if ftype.kind == ft.STRING:
        text = escape_text(text, opts.field_delim, opts.newline_policy)
        return F.coalesce(text, F.lit(opts.null_token))
    # Text of other types never holds a backslash or line end, but an unusual
    # delimiter such as '-', ':' or a digit can occur in it.
    if opts.field_delim.isalnum() or opts.field_delim in "+-.: ":
        text = escape_text(text, opts.field_delim)
    return F.coalesce(text, F.lit(opts.null_non_string_token))


def join_fields(fields: list[Column], delim: str) -> Column:
    """Join fields that are never null (``concat_ws`` would drop nulls)."""
    return fields[0] if len(fields) == 1 else F.concat_ws(delim, *fields)


# ---------------------------------------------------------------- decode

#: Fields whose parsing is generated as one method; see :func:`compiled_apart`.
FIELDS_PER_METHOD = 8


def compiled_apart(value: Column) -> Column:
    """``value`` unchanged, in a form that ends the fused stage at its projection.

    Spark fuses neighbouring projections into one generated method. For rows of
    many fields that method passes 8,000 bytecodes, above which the JVM only
    interprets it (24 s instead of 6 s for 4.8 million lines of eleven fields).
    A projection with a higher-order function is generated by itself, in small
    methods; placed after every few fields it keeps every method small, however
    wide the row. Two references keep the projection below from being merged in.
    """
    return F.get(F.transform(F.array(value, value), lambda x: x), F.lit(0))


def field_markers(delim: str, record_sep: str) -> tuple[str, str]:
    """Two control characters that stand for an escaped backslash and delimiter."""
    free = [chr(c) for c in range(8) if chr(c) not in (delim, record_sep)]
    return free[0], free[1]


def mark_escapes(text: Column, delim: str, markers: tuple[str, str]) -> Column:
    """Replace escaped backslashes, then escaped delimiters, by the markers.

    Pairs are taken from the left, so what remains of a run of backslashes is
    the one that escapes the next character.
    """
    text = F.replace(text, F.lit(ESCAPE * 2), F.lit(markers[0]))
    return F.replace(text, F.lit(ESCAPE + delim), F.lit(markers[1]))


def unmark(text: Column, delim: str, markers: tuple[str, str]) -> Column:
    """Unescaped text of a marked field."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(""))
    text = F.replace(text, F.lit(markers[1]), F.lit(delim))
    return F.replace(text, F.lit(markers[0]), F.lit(ESCAPE))


def unescape(text: Column) -> Column:
    """``\\x`` becomes ``x``."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def is_marked(line: Column, delim: str, record_sep: str) -> Column:
    """Whether a line takes the path with markers: escapes, but no marker in it."""
    m0, m1 = field_markers(delim, record_sep)
    return line.contains(ESCAPE) & ~(line.contains(m0) | line.contains(m1))


def raw_fields(line: Column, marked: Column, delim: str, record_sep: str) -> Column:
    """Fields of a line before unescaping; an escaped delimiter does not split.

    Lines without escapes take the plain split, and so do lines with escapes
    once these are marked. Only a line that holds both escapes and a marker
    character needs the pattern. That is possessive throughout, so that long
    fields cannot overflow the matcher's stack; the leading delimiter keeps an
    empty first field.
    """
    plain = ESCAPE + delim if delim in _REGEX_META else delim
    d = _code_point(delim)
    pattern = rf"(?s){d}([^{d}\\]*+(?:\\.[^{d}\\]*+)*+)"
    marks = field_markers(delim, record_sep)
    return (
        F.when(~line.contains(ESCAPE), F.split(line, plain, -1))
        .when(marked, F.split(mark_escapes(line, delim, marks), plain, -1))
        .otherwise(
            F.regexp_extract_all(F.concat(F.lit(delim), line), F.lit(pattern), F.lit(1))
        )
    )


def text_fields(line: Column, raw: Column, marked: Column, delim: str, record_sep: str) -> Column:
    """Unescaped fields of a line."""
    marks = field_markers(delim, record_sep)
    return (
        F.when(~line.contains(ESCAPE), raw)
        .when(marked, F.transform(raw, lambda field: unmark(field, delim, marks)))
        .otherwise(F.transform(raw, unescape))
    )


def is_null_field(raw: Column, marked: Column, ftype: FieldType, opts) -> Column:
    """Whether a raw field is a NULL: compared with the token before unescaping.

    A NULL of a non-string column is also recognised by its own token (by
    default the empty field), because that is how an unload writes it.
    """
    m0, _ = field_markers(opts.field_delim, opts.record_sep)
    tokens = [opts.null_token]
    if ftype.kind != ft.STRING:
        tokens.append(opts.null_non_string_token)

    def matches(token: str) -> Column:
        written = token.replace(ESCAPE * 2, m0)
        if written == token:
            return raw == F.lit(token)
        return raw == F.when(marked, F.lit(written)).otherwise(F.lit(token))

    found = matches(tokens[0])
    for token in tokens[1:]:
        found = found | matches(token)
    return found


def parse_bool(text: Column, words: tuple[str, str]) -> Column:
    """Only the two words of the style, in any letter case."""
    upper = F.upper(text)
    return F.when(upper == words[0], True).when(upper == words[1], False)


def parse_field(text: Column, is_null: Column, ftype: FieldType, opts) -> Column:
    """Typed value, NULL where the text does not parse; see :func:`badly_formed`."""
    value = _parse_text(text, ftype, opts)
    return F.when(~is_null, value) if _token_may_parse(ftype, opts) else value


def _token_may_parse(ftype: FieldType, opts) -> bool:
    """Whether a null token could be read as a value, so that it must be looked for."""
    if ftype.kind in (ft.STRING, ft.TIME):
        return True
    for token in (opts.null_token, opts.null_non_string_token):
        if any(c.isdigit() for c in token) or token.upper() in opts.bool_words:
            return True
        if ftype.kind == ft.DOUBLE and token.strip("+- ").lower()[:3] in ("nan", "inf"):
            return True
    return False


def _parse_text(text: Column, ftype: FieldType, opts) -> Column:
    if ftype.kind == ft.STRING:
        if ftype.width is None:
            return text
        cut = F.left(text, F.lit(ftype.width))
        return char_pad(cut, ftype.width) if ftype.padded else cut
    if ftype.kind == ft.TIME:
        return text
    if ftype.kind == ft.BOOLEAN:
        return parse_bool(text, opts.bool_words)
    return text.try_cast(ftype.sql)


def badly_formed(
    text: Column, value: Column, is_null: Column, ftype: FieldType
) -> Column | None:
    """True where the text of a field is neither NULL nor a strict literal of its type.

    ``try_cast`` alone is lenient (blanks, short dates, silent rounding). A text
    equal to the canonical rendering of the value passes without a regular
    expression; only other spellings are matched against the strict pattern.
    """
    if ftype.kind == ft.STRING:
        return None
    if ftype.kind == ft.BOOLEAN:
        return value.isNull() & ~is_null
    if ftype.kind == ft.TIME:
        return value.isNotNull() & ~text.rlike(STRICT_TEXT[ft.TIME])
    if ftype.kind == ft.DECIMAL:
        scale = int(ftype.sql.rstrip(")").split(",")[1])
        digits = rf"\.[0-9]{{0,{scale}}}0*"
        pattern = rf"\A[+-]?(?:[0-9]+(?:{digits})?|(?=\.[0-9]){digits})\z"
    else:
        pattern = STRICT_TEXT[ftype.kind]
    strict = (value.cast("string") == text) | text.rlike(pattern)
    return F.when(value.isNull(), ~is_null).otherwise(~strict)


def dangling_escape(line: Column) -> Column:
    """The line ends in a backslash that escapes nothing."""
    return line.endswith(ESCAPE) & line.rlike(_DANGLING_ESCAPE)


def bare_line_end(line: Column) -> Column:
    """The line holds a CR or LF that is not escaped."""
    rest = F.replace(line, F.lit("\r"), F.lit("\n"))
    for escaped in (ESCAPE * 2, ESCAPE + "\n"):
        rest = F.replace(rest, F.lit(escaped), F.lit(""))
    return (line.contains("\r") | line.contains("\n")) & rest.contains("\n")


# ---------------------------------------------------------------- comparison

def null_safe_equal(left: Column, right: Column) -> Column:
    """Equality in which NULL equals NULL."""
    return left.eqNullSafe(right)
