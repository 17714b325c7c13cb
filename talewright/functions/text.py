"""String column functions (JVM built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() treats as whitespace
# (str.isspace), by code point.
PY_WHITESPACE_CODEPOINTS = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
PY_WHITESPACE = "".join(map(chr, PY_WHITESPACE_CODEPOINTS))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Strip leading and trailing whitespace the way Python's ``str.strip``
    does (``btrim`` with the whitespace set: generated code, no regex)."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE))


def coalesce_key(col, default: str = "") -> Column:
    """Missing value -> default (PRJ2)."""
    return F.coalesce(_c(col), F.lit(default))


def chars_of(col) -> Column:
    """Array of the characters (code points) of a string. A split at the empty
    pattern cuts the bytes at character starts, without a regex; of an empty
    string it would give one empty piece."""
    c = _c(col)
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(c, ""))


def ids_to_string(col) -> Column:
    """Render an int array as ``"1,2,3"`` (stable value hashing / display)."""
    return F.array_join(_c(col).cast("array<string>"), ",")


def utf8_prefix(col, max_bytes) -> Column:
    """Longest prefix of ``col`` whose UTF-8 encoding fits in ``max_bytes``
    bytes, cut at a character boundary: the byte prefix is taken, then an
    incomplete trailing sequence (a lead byte missing continuation bytes) is
    removed. Only the tail is matched, so the regex cost does not grow with
    the text."""
    hexed = F.hex(F.substring(F.encode(_c(col), "UTF-8"), 1, max_bytes))
    whole = F.regexp_replace(hexed, INCOMPLETE_UTF8_TAIL_HEX, "")
    return F.decode(F.unhex(whole), "UTF-8")


# Fixed value: an incomplete UTF-8 sequence at the end of an upper-case hex
# string (2-, 3- or 4-byte lead byte followed by too few continuation bytes).
INCOMPLETE_UTF8_TAIL_HEX = (
    "(?:[CD][0-9A-F]|E[0-9A-F](?:[89AB][0-9A-F])?|F[0-7](?:[89AB][0-9A-F]){0,2})$"
)
