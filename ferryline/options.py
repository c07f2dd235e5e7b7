"""Transfer settings. Every rule that can be checked without data is checked here."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from ferryline.functions.tokens import deescape_token

ESCAPE = "\\"
DEFAULT_NULL_TOKEN = "null"
NEWLINE_POLICIES = ("reject", "space", "escape", "continue")

# The text written and read for each boolean style.
BOOL_STYLES = {
    "T_F": ("T", "F"),
    "TRUE_FALSE": ("TRUE", "FALSE"),
}

# Layouts that the bulk text path refuses.
DIRECT_LAYOUTS = ("text",)


def _check_common(opts) -> None:
    if opts.enclosed_by:
        warnings.warn("fields are never enclosed; enclosed_by is ignored", stacklevel=4)
        object.__setattr__(opts, "enclosed_by", None)
    if opts.record_delim:
        warnings.warn("record_delim is ignored; see record_sep", stacklevel=4)
        object.__setattr__(opts, "record_delim", None)
    if opts.escape != ESCAPE:
        warnings.warn("only backslash can be the escape character; using it", stacklevel=4)
        object.__setattr__(opts, "escape", ESCAPE)
    if int(opts.max_errors) != float(opts.max_errors):
        raise ValueError("max_errors must be a whole number")
    object.__setattr__(opts, "max_errors", int(opts.max_errors))
    if opts.max_errors < 1:
        raise ValueError("max_errors must be at least 1")
    if opts.bool_style not in BOOL_STYLES:
        raise ValueError(f"bool_style must be one of {tuple(BOOL_STYLES)}")
    # Printed numbers, times and booleans hold no control characters, so no record breaks.
    if len(opts.record_sep) != 1 or opts.record_sep == "\r" or opts.record_sep >= " ":
        raise ValueError("record_sep must be one control character, not CR")
    if len(opts.field_delim) != 1 or opts.field_delim in (
        ESCAPE, "\r", "\n", opts.record_sep
    ):
        raise ValueError("field_delim must be one character, not a line end or backslash")
    for token in (opts.null_token, opts.null_non_string or ""):
        trailing = len(token) - len(token.rstrip(ESCAPE))
        if trailing % 2 or any(
            c in token for c in (opts.field_delim, opts.record_sep, "\r", "\n")
        ):
            raise ValueError(f"null token {token!r} could not be read back from a line")


def check_direct(opts, *, layout: str = "text", query: str | None = None,
                 mode: str = "append") -> None:
    """Refuse settings that the bulk text path cannot honour."""
    if layout not in DIRECT_LAYOUTS:
        raise ValueError(f"unsupported argument for a direct transfer: format={layout!r}")
    if query is not None:
        raise ValueError("a direct transfer cannot import a free-form query")
    if mode == "update":
        raise ValueError("a direct transfer does not support update mode")
    if opts.null_non_string is not None:
        raise ValueError(
            "a direct transfer supports no custom null token for non-string columns"
        )


class _TokenMixin:
    @property
    def null_token(self) -> str:
        """The de-escaped null token as it stands in the text."""
        if self.null_string is None:
            return DEFAULT_NULL_TOKEN
        return deescape_token(self.null_string)

    @property
    def null_non_string_token(self) -> str:
        """What a NULL of a non-string column looks like in the text."""
        return "" if self.null_non_string is None else self.null_non_string

    @property
    def bool_words(self) -> tuple[str, str]:
        return BOOL_STYLES[self.bool_style]


@dataclass(frozen=True)
class UnloadOptions(_TokenMixin):
    """Table to delimited text."""

    field_delim: str = ","
    escape: str | None = ESCAPE
    enclosed_by: str | None = None
    record_delim: str | None = None
    null_string: str | None = None
    null_non_string: str | None = None
    bool_style: str = "T_F"
    ctrl_chars: bool = False
    #: what to do with CR/LF inside a string: reject the row, write a blank, escape (with a
    #: record_sep of its own), or escape and let the record go on in the next line
    newline_policy: str = "reject"
    record_sep: str = "\n"
    max_errors: int = 1
    rejects_path: str | None = None
    compression: str | None = None
    #: CHAR(n) columns whose width the DataFrame schema does not carry
    char_widths: Mapping[str, int] = field(default_factory=dict)
    #: TIME columns that arrive as timestamps
    time_columns: tuple[str, ...] = ()

    def __post_init__(self):
        _check_common(self)
        object.__setattr__(self, "char_widths", MappingProxyType(dict(self.char_widths)))
        if self.newline_policy not in NEWLINE_POLICIES:
            raise ValueError(f"newline_policy must be one of {NEWLINE_POLICIES}")
        if self.newline_policy == "escape" and self.record_sep == "\n":
            raise ValueError("newline_policy='escape' needs a record_sep other than LF")
        if self.newline_policy == "continue" and self.record_sep != "\n":
            raise ValueError("newline_policy='continue' needs LF as record_sep")


@dataclass(frozen=True)
class LoadOptions(_TokenMixin):
    """Delimited text to table."""

    field_delim: str = ","
    escape: str | None = ESCAPE
    enclosed_by: str | None = None
    record_delim: str | None = None
    null_string: str | None = None
    null_non_string: str | None = None
    bool_style: str = "TRUE_FALSE"
    ctrl_chars: bool = False
    record_sep: str = "\n"
    max_errors: int = 1
    rejects_path: str | None = None
    #: records may go on after an escaped LF (newline_policy "continue")
    continued_lines: bool = False

    def __post_init__(self):
        _check_common(self)
        if self.continued_lines and self.record_sep != "\n":
            raise ValueError("continued_lines needs LF as record_sep")


@dataclass(frozen=True)
class Connection:
    """A JDBC endpoint. Credentials are left out when ``user`` is empty."""

    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    options: Mapping[str, str] = field(default_factory=dict)
    #: Column of every table that tells where the warehouse keeps a row, never NULL
    #: nor negative; reads in several slices use it where no key is named.
    locality_column: str | None = None
    #: One-row query for the type of an object; ``{name}`` and ``{schema}`` are
    #: replaced by quoted literals (``{schema}`` by CURRENT_SCHEMA when unset).
    catalog_query: str = (
        "SELECT TABLE_TYPE FROM INFORMATION_SCHEMA.TABLES"
        " WHERE TABLE_NAME = {name} AND TABLE_SCHEMA = {schema}"
    )

    def properties(self) -> dict[str, str]:
        """Spark JDBC options, without the table."""
        props = {"url": self.url, **self.options}
        if self.driver:
            props["driver"] = self.driver
        if self.user:
            props["user"] = self.user
            props["password"] = self.password or ""
        return props
