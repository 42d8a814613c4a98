"""Removal of junk that models put in front of their answers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plumbline.functions.text import WS, lstrip, strip

# What may stand in front of an answer, in any number and order.
# The possessive repeats make the match linear and free of recursion.
_JUNK = (
    r"(?iu)\A(?:"
    rf"[{WS}\x{{feff}}\x{{fffd}}]++"
    rf"|(?:\x{{1f310}}{WS}*+)?assistant{WS}*+:"
    rf"|im_assistant{WS}*+:"
    rf"|limelight{WS}*+:"
    r"|em\p{Nd}++\."
    r")++"
)
_QUOTES = "`\"' \n\t"


def clean(c: Column) -> Column:
    """Null becomes '', junk prefixes and opening quotes go, line ends become LF."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), F.lit(_JUNK), F.lit(""))
    t = lstrip(t, _QUOTES)
    t = F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return strip(t)
