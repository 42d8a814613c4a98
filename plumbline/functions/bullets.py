"""Bullet and question rules over a cleaned answer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plumbline.functions.text import NOT_WS, WS_IN_LINE

# A bullet line: marker, white space, then something on the same line.
_BULLET = (
    rf"(?dm)^{WS_IN_LINE}*+(?:[-*•]|\p{{Nd}}++[.)]|[A-Za-z][.)])"
    rf"{WS_IN_LINE}++{NOT_WS}"
)


def bullet_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_BULLET)).cast("bigint")


def prefixed_count(lines: Column, prefix: Column) -> Column:
    """Lines (already stripped) that start with the prefix."""
    return F.size(F.filter(lines, lambda s: s.startswith(prefix))).cast("bigint")


def first_lines(lines: Column, n: Column) -> Column:
    """The first n lines; a negative n drops that many from the end."""
    size = F.size(lines)
    keep = F.when(n >= 0, F.least(n, size)).otherwise(F.greatest(size + n, F.lit(0)))
    return F.slice(lines, F.lit(1), keep.cast("int"))


def all_questions(lines: Column) -> Column:
    return F.forall(lines, lambda s: F.contains(s, F.lit("?")))
