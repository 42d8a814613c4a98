"""Roll-up of verdicts into pass rates, wins and ties."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.operators.filters import select_variant
from plumbline.settings import MODELS


def _model_rows(df: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """One row per model, so that a model without data is reported too."""
    return df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, models))).alias("model"))


def pass_all_rate(verdicts: DataFrame, models: tuple[str, ...] = MODELS) -> DataFrame:
    """Per model: answers that pass all checks among those that have checks."""
    rows = verdicts.where(F.col("model").isin(*models)).select("model", "pass_all")
    rows = rows.unionByName(_model_rows(verdicts, models), allowMissingColumns=True)
    return (
        rows.groupBy("model")
        .agg(F.count_if("pass_all").alias("passed"), F.count("pass_all").alias("applicable"))
        .withColumn("rate", F.try_divide("passed", "applicable"))
    )


def per_check_rate(results: DataFrame, models: tuple[str, ...] = MODELS) -> DataFrame:
    """Per model and check type: passed among all that could be judged."""
    return (
        results.where(F.col("model").isin(*models))
        .groupBy("model", F.col("type").alias("check_type"))
        .agg(F.count_if("pass").alias("passed"), F.count("pass").alias("total"))
        .withColumn("rate", F.try_divide("passed", "total"))
    )


def _outcome(scores: dict[str, Column]) -> Column:
    """The one model with the best score, or 'tie'; null when nobody has a score."""
    best = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    at_best = reduce(
        Column.__add__, [F.coalesce((s == best).cast("int"), F.lit(0)) for s in scores.values()]
    )
    winner = F.coalesce(*[F.when(s == best, F.lit(m)) for m, s in scores.items()])
    return F.when(at_best == 1, winner).when(at_best > 1, "tie")


def wins_and_ties(
    verdicts: DataFrame, skip_unchecked: bool = False, models: tuple[str, ...] = MODELS
) -> DataFrame:
    """How many prompts each model wins by most passed checks, and the ties.

    Prompts without checks are ties, as every model scores nothing on them;
    ``skip_unchecked`` leaves them out. Scores are numbers in fixed slots, so a
    prompt needs one hash aggregation and no window.
    """
    per_prompt = verdicts.groupBy("id").agg(
        *[F.max(F.when(F.col("model") == m, F.col("n_passed"))).alias(m) for m in models],
        F.count("pass_all").alias("_checked"),
    )
    if skip_unchecked:
        per_prompt = per_prompt.where(F.col("_checked") > 0)
    outcomes = per_prompt.select(_outcome({m: F.col(m) for m in models}).alias("outcome"))
    names = [*models, "tie"]
    counts = outcomes.agg(*[F.count_if(F.col("outcome") == n).alias(n) for n in names])
    return counts.unpivot([], names, "outcome", "n").where(
        (F.col("n") > 0) | (F.col("outcome") == "tie")
    )


def _fact(metric: str, models: tuple[str, ...], **fields: Column) -> Column:
    """A contribution to one metric; a score keeps its prompt and has a slot per model."""
    kinds = {"id": "string", "model": "string", "check_type": "string", "num": "bigint", "den": "bigint"}
    kinds |= {f"score_{m}": "bigint" for m in models}
    return F.struct(
        F.lit(metric).alias("metric"),
        *(fields.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()),
    )


def eval_summary(
    evaluated: DataFrame, variant: str = "det", models: tuple[str, ...] = MODELS
) -> DataFrame:
    """All rates, wins and ties of one variant as rows of one table.

    The answers are evaluated once: each yields its contributions to the rates
    and one score for its prompt, and a hash aggregation over numbers only takes
    both together. Rates come out of it as one row per task and metric, scores
    as one row per prompt, which give wins and ties. Every answer counts in the
    rates, also where a prompt, model and variant have several; the best of
    them is the model's score. Win and tie rows have no denominator.
    """
    slots = [f"score_{m}" for m in models]
    model, n_passed = F.col("model"), F.col("n_passed")
    overall = _fact(
        "pass_all_rate",
        models,
        model=model,
        num=F.coalesce(F.col("pass_all").cast("bigint"), F.lit(0)),
        den=F.isnotnull("pass_all").cast("bigint"),
    )
    score = _fact(
        "score", models, id=F.col("id"), **{f"score_{m}": F.when(model == m, n_passed) for m in models}
    )
    by_check = F.transform(
        "results",
        lambda r: _fact(
            "per_check_rate",
            models,
            model=model,
            check_type=r["type"],
            num=F.coalesce(r["pass"].cast("bigint"), F.lit(0)),
            den=F.isnotnull(r["pass"]).cast("bigint"),
        ),
    )
    rows = select_variant(evaluated, variant).where(model.isin(*models))
    facts = rows.select(F.inline_outer(F.concat(F.array(overall, score), by_check))).where(
        F.isnotnull("metric")
    )
    keys = ("metric", "id", "model", "check_type")
    sums = facts.groupBy(*keys).agg(
        F.sum("num").alias("num"), F.sum("den").alias("den"), *(F.max(s).alias(s) for s in slots)
    )
    outcome = _outcome({m: F.col(f"score_{m}") for m in models})
    is_score = F.col("metric") == "score"
    told = sums.withColumn("outcome", F.when(is_score, outcome)).select(
        F.when(~is_score, F.col("metric"))
        .when(F.col("outcome") == "tie", "ties")
        .when(F.isnotnull("outcome"), "wins")
        .alias("metric"),
        F.when(is_score & (F.col("outcome") != "tie"), F.col("outcome")).otherwise(F.col("model")).alias("model"),
        "check_type",
        F.when(is_score, F.lit(1)).otherwise(F.col("num")).cast("bigint").alias("num"),
        "den",
    )
    zero = F.lit(0).cast("bigint")
    always = evaluated.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[_fact("pass_all_rate", models, model=F.lit(m), num=zero, den=zero) for m in models],
                _fact("ties", models, num=zero),
            )
        )
    )
    return (
        told.where(F.isnotnull("metric"))
        .unionByName(always.select("metric", "model", "check_type", "num", "den"))
        .groupBy("metric", "model", "check_type")
        .agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
        .withColumn("rate", F.try_divide("num", "den"))
    )


def dataset_row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
