"""Preference pairs → sampled triplets → likelihoods → accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.operators.joins import join_chosen_rejected
from plumbline.operators.preference import (
    completion_loglik,
    preference_accuracy,
    tie_aware_accuracy,
)
from plumbline.operators.sampling import sample_n, train_test_split
from plumbline.operators.shaping import clean_triplets, normalize_preference_schema


def evaluation_triplets(
    raw: DataFrame, n_samples: int, seed: int = 42, key: str = "pair_id"
) -> DataFrame:
    """Held-out sample of pairs as clean texts. Texts are touched after sampling only."""
    test = train_test_split(raw, n_samples, seed, key).where(F.col("part") == "test")
    picked = sample_n(test, n_samples, seed, key)
    return clean_triplets(normalize_preference_schema(picked))


def preference_metrics(
    tokens: DataFrame, max_prompt: int, max_completion: int, models: tuple[str, ...] | None = None
) -> DataFrame:
    logliks = completion_loglik(tokens, max_prompt, max_completion)
    return tie_aware_accuracy(preference_accuracy(join_chosen_rejected(logliks), models=models))
