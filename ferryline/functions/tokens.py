"""Driver-side handling of the user's null token (option text, not row data)."""

from __future__ import annotations

import re

# The escape sequences a null token may contain.
TOKEN_ESCAPES = {
    "b": "\b",
    "t": "\t",
    "n": "\n",
    "f": "\f",
    "'": "'",
    '"': '"',
    "\\": "\\",
}

_PAIR = re.compile(r"\\(.)", re.DOTALL)


def deescape_token(token: str) -> str:
    """Resolve the escapes of :data:`TOKEN_ESCAPES` in one left-to-right pass.

    Unknown pairs such as ``\\N`` or ``\\r`` stay as they are. Octal escapes are
    refused wherever they stand, except behind an escaped backslash.
    """
    for pair in _PAIR.finditer(token):
        if pair.group(1) in "0123456789":
            raise ValueError(
                f"octal escapes are not supported in a null token: {token!r}"
            )
    return _PAIR.sub(lambda m: TOKEN_ESCAPES.get(m.group(1), m.group(0)), token)
