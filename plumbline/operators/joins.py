"""Joins of prompts, answers, verdicts and paired scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.operators.scale import lookup_join
from plumbline.settings import MODELS


def join_prompts_outputs(prompts: DataFrame, generations: DataFrame) -> DataFrame:
    """Every answer with its prompt and declared checks, matched by id."""
    answers = generations.select("id", "model", "variant", "raw")
    return lookup_join(answers, prompts.select("id", "prompt", "checks"), ["id"]).select(
        "id", "model", "variant", "prompt", "checks", "raw"
    )


def join_checks(prompts: DataFrame, generations: DataFrame) -> DataFrame:
    """The same without the prompt text, for checks that are already complete."""
    answers = generations.select("id", "model", "variant", "raw")
    return lookup_join(answers, prompts.select("id", "checks"), ["id"])


def _of(model: str, field: str) -> Column:
    return F.col(f"{model}_{field}")


# How a verdict is shown.
def _verdict_text(model: str) -> Column:
    verdict = _of(model, "verdict")
    passed = (
        F.when(verdict["pass_all"], "True").when(~verdict["pass_all"], "False").otherwise("None")
    )
    checks = F.coalesce(verdict["checks"], F.lit("[]"))
    return F.when(
        F.isnotnull(verdict), F.concat(F.lit("pass_all="), passed, F.lit(" | checks="), checks)
    ).otherwise("N/A")


def replay_lookup(
    prompts: DataFrame,
    answers: DataFrame,
    requests: DataFrame,
    models: tuple[str, ...] = MODELS,
) -> DataFrame:
    """Stored prompt, answers and verdicts of each requested (id, variant).

    ``prompts`` holds id and prompt of every stored item, ``answers`` id, model,
    variant, raw and verdict (pass_all, checks as JSON text). A stored prompt
    without answers is shown with empty ones and ``N/A``; requests for an
    unknown id are given by ``unknown_requests``. Answers are reduced to the
    requested ones first and pivoted where that join leaves them, each once
    however often it is requested; prompts are joined at the end.
    """
    wanted = requests.select("id", "variant").distinct()
    # An id and variant have one answer per model, so this key is never hot.
    chosen = answers.join(wanted, ["id", "variant"], "left_semi")
    wide = chosen.groupBy("id", "variant").agg(
        *[
            F.any_value(F.when(F.col("model") == m, F.col(c)), F.lit(True)).alias(f"{m}_{c}")
            for m in models
            for c in ("raw", "verdict")
        ],
    )
    # The reply's wording.
    heading = {m: f"**{m.capitalize() if m == 'base' else m.upper()}:** " for m in models}
    text = F.concat(
        *[
            x
            for i, m in enumerate(models)
            for x in (F.lit(("\n\n" if i else "") + heading[m]), _verdict_text(m))
        ],
        F.lit("\n"),
    )
    found = lookup_join(requests.select("id", "variant"), wide, ["id", "variant"], "left")
    replies = found.select(
        "id", "variant", *[_of(m, "raw").alias(m) for m in models], text.alias("eval_text")
    )
    return lookup_join(replies, prompts.select("id", "prompt"), ["id"]).select(
        "id", "variant", "prompt", *models, "eval_text"
    )


def unknown_requests(prompts: DataFrame, requests: DataFrame) -> DataFrame:
    """``id, n``: requested ids that no stored prompt has, and how often."""
    counted = requests.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(prompts.select("id"), "id", "left_anti")


def join_chosen_rejected(logliks: DataFrame) -> DataFrame:
    """Both log-likelihoods of a pair side by side; one aggregation, no self-join.

    A side that has no row is null, and so is the margin. Completions without
    tokens are no missing side: ``completion_loglik`` keeps them by its ``pairs``.
    """

    def side(name: str) -> Column:
        return F.sum(F.when(F.col("side") == name, F.col("logp")))

    return (
        logliks.groupBy("pair_id", "model")
        .agg(side("chosen").alias("logp_chosen"), side("rejected").alias("logp_rejected"))
        .withColumn("margin", F.col("logp_chosen") - F.col("logp_rejected"))
    )
