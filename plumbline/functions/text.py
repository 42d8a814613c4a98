"""White space, lines and tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The 29 characters Python's str.strip() removes.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# The same set as a regular-expression class, with and without the line feed.
WS = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
WS_IN_LINE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}&&[^\n]]"
NOT_WS = r"[^\s\x{1c}-\x{1f}\x{85}\p{Z}]"

# Edges of a Unicode word (letters, numbers, underscore).
WORD_START = r"(?<![\p{L}\p{N}_])"
WORD_END = r"(?![\p{L}\p{N}_])"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def lstrip(c: Column, chars: str = WS_CHARS) -> Column:
    return F.ltrim(c, F.lit(chars))


def lines(c: Column) -> Column:
    """Stripped non-empty lines. Only the line feed ends a line."""
    return F.filter(F.transform(F.split(c, "\n", -1), strip), lambda s: s != "")


def words(c: Column) -> Column:
    """White-space tokens, the default where no token column is supplied."""
    return F.array_remove(F.split(c, WS, -1), "")


def last_index(c: Column, char: str) -> Column:
    """1-based place of the last ``char`` (a single character); 0 when absent."""
    return F.char_length(c) - F.char_length(F.substring_index(c, char, -1))
