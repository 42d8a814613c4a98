"""Checks read off the wording of a prompt."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plumbline.functions.text import WORD_END, WORD_START, WS


def _word(text: str) -> str:
    """Pattern for the start of a word; looks back after the letters, which is faster."""
    return rf"{text}(?<![\p{{L}}\p{{N}}_]{text})"


_LARGEST = (1 << 63) - 1

# The wordings that state a rule.
_BULLETS = (
    rf"(?iu){_word('exactly')}{WS}+([0-9]+){WS}+bullets?{WORD_END}",
    rf"(?iu){_word('in')}{WS}+([0-9]+){WS}+bullets?{WORD_END}",
)
_QUESTIONS = (
    rf"(?iu){_word('ask')}(?:{WS}+me)?{WS}+([0-9]+){WS}+questions?{WORD_END}",
    rf"(?iu){_word('first')}{WS}+([0-9]+){WS}+questions?{WORD_END}",
)
_JSON_ONLY = rf"(?iu){_word('return')}{WS}+only{WS}+valid{WS}+json{WORD_END}"
# How a prompt shows keys and allowed values.
_QUOTED_KEY = rf'"([A-Za-z_][A-Za-z0-9_]*)"{WS}*:'
_ENUM = (
    rf"{WORD_START}[A-Za-z_][A-Za-z0-9_]*+{WORD_END}{WS}*+:{WS}*+"
    rf'"[^"]++"(?:{WS}*+\|{WS}*+"[^"]++")++'
)
_NAME = r"\A[A-Za-z0-9_]+"
_QUOTED = r'"([^"]+)"'


def _first_number(prompt: Column, patterns: tuple[str, ...]) -> Column:
    """The number of the first wording found; one beyond BIGINT is the largest BIGINT."""
    digits = F.coalesce(*[F.nullif(F.regexp_extract(prompt, p, 1), F.lit("")) for p in patterns])
    return F.when(
        F.isnotnull(digits), F.coalesce(digits.try_cast("bigint"), F.lit(_LARGEST).cast("bigint"))
    )


def bullets(prompt: Column) -> Column:
    return _first_number(prompt, _BULLETS)


def questions(prompt: Column) -> Column:
    return _first_number(prompt, _QUESTIONS)


def wants_json(prompt: Column) -> Column:
    return prompt.rlike(_JSON_ONLY)


def required_keys(prompt: Column) -> Column:
    """Quoted names before a colon, in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(prompt, F.lit(_QUOTED_KEY), F.lit(1)))


def enums(prompt: Column) -> Column:
    """Unquoted ``key: "a"|"b"`` lists; a repeated key keeps the last list."""
    found = F.when(
        prompt.rlike(rf'"{WS}*\|{WS}*"'), F.regexp_extract_all(prompt, F.lit(_ENUM), F.lit(0))
    ).otherwise(F.array().cast("array<string>"))
    names = F.transform(found, lambda m: F.regexp_extract(m, _NAME, 0))
    values = F.transform(
        found,
        lambda m: F.regexp_extract_all(m, F.lit(_QUOTED), F.lit(1)),
    )
    return F.map_from_arrays(names, values)
