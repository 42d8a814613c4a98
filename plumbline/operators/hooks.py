"""Where a model enters: caller-supplied batch functions over Arrow batches."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from plumbline import schemas
from plumbline.settings import MODELS

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _in_batches(
    frames: Iterator[pd.DataFrame], column: str
) -> Iterator[pd.DataFrame]:
    """Regroup Arrow batches into the planned ones; rows come sorted by ``column``."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if frame.empty:
            continue
        open_batch = frame[column] == frame[column].iloc[-1]
        for _, batch in frame[~open_batch].groupby(column, sort=False):
            yield batch
        rest = frame[open_batch]
    if rest is not None and len(rest):
        yield rest


def batch_generate(
    batches: DataFrame,
    load: Callable[[str], Callable[[Sequence[str], str], Sequence[str]]],
    models: Sequence[str] = MODELS,
    variants: Sequence[str] = ("det",),
    prompt: str = "chat_prompt",
) -> DataFrame:
    """Fill one answer per prompt, model and variant.

    ``batches`` carries ``batch_id`` (see ``length_sorted_batches``). A batch
    stays together and crosses the shuffle once; only behind it is it repeated
    for each model. ``load(model)`` runs once per task and model,
    ``fn(prompts, variant)`` once per batch. Filter prompts before this step:
    no predicate moves through Python.
    """
    work = (
        batches.select("id", prompt, "batch_id")
        .repartition("batch_id")
        .withColumn("model", F.explode(F.array(*map(F.lit, models))))
        .withColumn("_job", F.concat_ws(":", "model", "batch_id"))
        .sortWithinPartitions("model", "batch_id", "id")
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, fn = None, None
        for batch in _in_batches(frames, "_job"):
            if batch["model"].iloc[0] != name:
                name = batch["model"].iloc[0]
                fn = load(name)
            for variant in variants:
                answers = list(fn(batch[prompt].tolist(), variant))
                if len(answers) != len(batch):
                    raise ValueError("one answer per prompt is needed")
                yield pd.DataFrame(
                    {"id": batch["id"], "model": name, "variant": variant, "raw": answers}
                )

    return work.mapInPandas(run, schemas.GENERATION)


def batch_score(
    pairs: DataFrame,
    load: Callable[[str], Callable[[Sequence[str], Sequence[str]], Sequence[tuple]]],
    models: Sequence[str] = MODELS,
    batch_size: int = 4,
    prompt: str = "chat_prompt",
) -> DataFrame:
    """Token log-probabilities of both completions of every pair.

    ``fn(prompts, completions)`` gives per text the number of prompt tokens and
    the log-probability of every token of the whole text. Texts stay where they
    are: each task scores its own pairs, one model after the other, and gives
    one frame per batch and side.
    """
    sides = ("chosen", "rejected")
    work = (
        pairs.select("pair_id", prompt, *sides)
        .withColumn("model", F.explode(F.array(*map(F.lit, models))))
        .sortWithinPartitions("model")
    )

    def score(fn, name: str, side: str, part: pd.DataFrame) -> pd.DataFrame:
        scored = list(fn(part[prompt].tolist(), part[side].tolist()))
        if len(scored) != len(part):
            raise ValueError("one result per text is needed")
        sizes = np.array([len(logps) for _, logps in scored], np.int64)
        pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        prompts = np.repeat(np.array([n for n, _ in scored], np.int64), sizes)
        return pd.DataFrame(
            {
                "pair_id": part["pair_id"].to_numpy().repeat(sizes),
                "model": name,
                "side": side,
                "pos": pos,
                "is_prompt": pos < prompts,
                "logp": np.concatenate([np.asarray(logps, float) for _, logps in scored]),
            }
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, fn = None, None
        for frame in frames:
            for model, rows in frame.groupby("model", sort=False):
                if model != name:
                    name, fn = model, load(model)
                for at in range(0, len(rows), batch_size):
                    for side in sides:
                        yield score(fn, name, side, rows.iloc[at : at + batch_size])

    return work.mapInPandas(run, schemas.TOKEN_LOGP)
