"""Raw preferences → supervised and pairwise training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from plumbline.operators.shaping import build_preference_pairs, build_sft_pairs
from plumbline.sources.writers import sink_pairs_json


def prepare_training_sets(raw: DataFrame, path: str, fmt: str = "json") -> dict[str, int]:
    """Write both sets under ``path``; gives the rows written to each."""
    return {
        "sft": sink_pairs_json(build_sft_pairs(raw), f"{path}/sft", fmt),
        "dpo": sink_pairs_json(build_preference_pairs(raw), f"{path}/dpo", fmt),
    }
