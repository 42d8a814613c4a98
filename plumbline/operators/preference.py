"""Log-likelihood of completions and preference accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.functions.text import words
from plumbline.operators.scale import lookup_join


def completion_loglik(
    tokens: DataFrame,
    max_prompt: int = 1024,
    max_completion: int = 256,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Sum of token log-probabilities over the completion inside the budget.

    ``tokens`` holds ``pos`` in the whole text and ``is_prompt`` for its leading
    prompt part. The whole text is cut at the two budgets together, so a short
    prompt lends its room to the completion, and the part of a prompt beyond
    its own budget counts as completion. The first token has no prediction.
    All of this is told by the row alone: no window, one partial aggregation.
    ``pairs`` (pair_id, model, side) keeps completions that have no token row.
    """
    pos = F.col("pos")
    scored = (
        (~F.col("is_prompt") | (pos >= max_prompt))
        & (pos >= 1)
        & (pos < max_prompt + max_completion)
    )
    rows = tokens.select("pair_id", "model", "side", F.when(scored, F.col("logp")).alias("logp"))
    if pairs is not None:
        rows = rows.unionByName(pairs.select("pair_id", "model", "side"), allowMissingColumns=True)
    return rows.groupBy("pair_id", "model", "side").agg(
        F.coalesce(F.sum("logp"), F.lit(0)).alias("logp")
    )


def preference_accuracy(
    margins: DataFrame, eps: float = 1e-6, models: tuple[str, ...] | None = None
) -> DataFrame:
    """Per model: pairs, share won by the chosen side, mean margin, ties.

    A margin between 0 and ``eps`` is a tie and correct. A margin that is not a
    number or not known (a pair that lacks a side) counts as a pair that was
    not won; the mean is over the known margins and shows a NaN. Models listed
    in ``models`` are reported even without pairs, with zeros.
    """
    rows = margins.select("model", "margin", F.lit(1).alias("pair"))
    if models is not None:
        listed = margins.sparkSession.range(1).select(
            F.explode(F.array(*map(F.lit, models))).alias("model")
        )
        rows = rows.where(F.col("model").isin(*models)).unionByName(listed, allowMissingColumns=True)
    margin, zero = F.col("margin"), F.lit(0.0)
    n, known = F.count("pair"), F.count("margin")
    won = (margin > 0) & ~F.isnan(margin.cast("double"))
    return rows.groupBy("model").agg(
        n.alias("n"),
        F.coalesce(F.try_divide(F.count_if(won), n), zero).alias("preference_accuracy"),
        F.coalesce(F.try_divide(F.sum("margin").cast("double"), known), zero).alias("avg_logp_margin"),
        F.count_if(F.abs(margin) < eps).alias("ties"),
    )


def tie_aware_accuracy(metrics: DataFrame) -> DataFrame:
    """Add accuracy without ties and accuracy with ties as half a win."""
    correct = F.round(F.col("preference_accuracy") * F.col("n"))
    return metrics.withColumns(
        {
            "accuracy_excl_ties": F.try_divide(correct, F.col("n") - F.col("ties")),
            "accuracy_w_ties_half": F.try_divide(
                correct + F.lit(0.5) * F.col("ties"), F.col("n")
            ),
        }
    )


def preference_margin_vs_reference(
    policy: DataFrame, reference: DataFrame, beta: float = 0.05
) -> DataFrame:
    """Margin of the policy over the reference model, and its logistic loss.

    Both inputs hold one row per pair: pair_id, logp_chosen, logp_rejected.
    """
    ref = reference.select(
        "pair_id",
        F.col("logp_chosen").alias("ref_chosen"),
        F.col("logp_rejected").alias("ref_rejected"),
    )
    gain = (F.col("logp_chosen") - F.col("logp_rejected")) - (
        F.col("ref_chosen") - F.col("ref_rejected")
    )
    margin = F.col("margin")
    # log(1 + exp(-m)) without overflow for large negative m
    loss = F.log1p(F.exp(-F.abs(margin))) + F.greatest(-margin, F.lit(0.0))
    return (
        policy.join(ref, "pair_id")
        .select("pair_id", (F.lit(beta) * gain).alias("margin"))
        .withColumn("loss", loss)
    )


def word_tokens(texts: DataFrame, keys: list[str], col: str = "text") -> DataFrame:
    """One row per white-space token with its place and the token before it.

    Outer, so that the optimizer does not add a filter that splits texts twice.
    """
    tokens = words(F.col(col))
    shifted = F.concat(F.array(F.lit("<s>")), tokens)
    return texts.select(
        *keys, F.posexplode_outer(F.arrays_zip(tokens.alias("token"), shifted.alias("prev")))
    ).select(
        *keys,
        F.col("pos").cast("bigint").alias("pos"),
        F.col("col.token").alias("token"),
        F.col("col.prev").alias("prev"),
    ).where(F.isnotnull("token"))


def ngram_token_logp(tokens: DataFrame, corpus: DataFrame, order: int = 2) -> DataFrame:
    """Add ``logp`` from add-one n-gram counts of a token table.

    Both tables hold ``token`` and ``prev``. The corpus is counted once, by
    pairs and partially before the shuffle; contexts and words are sums over
    those counts. An empty corpus gives null. A few words make up much of any text, so the look-up of their
    counts is skewed on the token side.
    """
    if order not in (1, 2):
        raise ValueError("order is 1 or 2")
    n = F.count(F.lit(1))
    if order == 1:
        unigrams = corpus.groupBy("token").agg(n.alias("_hits"))
        vocabulary = unigrams.agg(n).scalar()
        counted = lookup_join(tokens, unigrams, ["token"], "left")
        base = unigrams.agg(F.sum("_hits")).scalar()
    else:
        bigrams = corpus.groupBy("prev", "token").agg(n.alias("_hits"))
        vocabulary = bigrams.select("token").distinct().agg(n).scalar()
        contexts = bigrams.groupBy("prev").agg(F.sum("_hits").alias("_context"))
        counted = lookup_join(tokens, bigrams, ["prev", "token"], "left")
        counted = lookup_join(counted, contexts, ["prev"], "left")
        base = F.coalesce("_context", F.lit(0))
    chance = F.try_divide(F.coalesce("_hits", F.lit(0)) + F.lit(1), base + vocabulary)
    return counted.withColumn("logp", F.ln(chance)).drop("_hits", "_context")
