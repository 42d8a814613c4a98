"""Prompts and answers → cleaned answers with verdicts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from plumbline.operators.checks import judge, resolve_checks
from plumbline.operators.filters import drop_missing_outputs, skip_categories
from plumbline.operators.joins import join_checks
from plumbline.operators.shaping import clean_outputs


def evaluated_answers(
    prompts: DataFrame,
    generations: DataFrame,
    skip: Iterable[str] = ("safety_harm",),
    clean: bool = True,
    infer: bool = False,
) -> DataFrame:
    """Answers with cleaned text, check results and verdict.

    The filters come first, so that skipped prompts are neither joined nor
    judged. Prompt texts are read once per prompt and stay behind: only ids and
    checks are joined to the answers.
    """
    checks = resolve_checks(skip_categories(prompts, skip), infer)
    answers = join_checks(checks, drop_missing_outputs(generations))
    return judge(clean_outputs(answers, enabled=clean))
