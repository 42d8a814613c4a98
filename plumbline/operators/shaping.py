"""Projections and row shaping of preference data and generations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import schemas
from plumbline.functions import cleaning, messages
from plumbline.functions.messages import ChatTemplate
from plumbline.functions.text import strip
from plumbline.settings import MODELS, VARIANTS


def _typed(df: DataFrame, name: str):
    return F.col(name), df.schema[name].dataType


def union_splits(dfs: list[DataFrame]) -> DataFrame:
    """All rows of all splits; nothing is removed."""
    return reduce(DataFrame.unionByName, dfs)


def last_message_text(df: DataFrame, col: str = "chosen", out: str = "text") -> DataFrame:
    """Add the text of the last message, whatever its role."""
    return df.withColumn(out, messages.last_text(*_typed(df, col)))


def last_turn_text(df: DataFrame, conv: str = "conv_id", user_only: bool = False) -> DataFrame:
    """The same over one row per turn; the last user turn first if ``user_only``."""
    last = F.max_by("text", "turn")
    if user_only:
        last = F.coalesce(F.max_by("text", F.when(F.col("role") == "user", F.col("turn"))), last)
    else:
        last = strip(last)
    return df.groupBy(conv).agg(last.alias("text"))


def last_user_message(df: DataFrame, col: str = "messages", out: str = "prompt") -> DataFrame:
    """Add the last user message of a list, or its last message if no user spoke."""
    return df.withColumn(out, messages.last_user_text(*_typed(df, col)))


def normalize_preference_schema(df: DataFrame) -> DataFrame:
    """``prompt/chosen/rejected`` or ``messages/chosen/rejected`` → three strings."""
    names = set(df.columns)
    if not {"chosen", "rejected"} <= names or not names & {"prompt", "messages"}:
        raise KeyError(f"could not extract preference fields from columns {df.columns}")
    source = "prompt" if "prompt" in names else "messages"
    kept = [c for c in df.columns if c not in ("prompt", "messages", "chosen", "rejected")]
    return df.select(
        *kept,
        messages.last_user_text(*_typed(df, source)).alias("prompt"),
        messages.last_text(*_typed(df, "chosen")).alias("chosen"),
        messages.last_text(*_typed(df, "rejected")).alias("rejected"),
    )


def _prompt_text(df: DataFrame) -> Column:
    return strip(messages.last_user_text(*_typed(df, "prompt")))


def build_sft_pairs(raw: DataFrame) -> DataFrame:
    return raw.select(
        _prompt_text(raw).alias("prompt"),
        messages.last_text(*_typed(raw, "chosen")).alias("response"),
    )


def build_preference_pairs(raw: DataFrame) -> DataFrame:
    return raw.select(
        _prompt_text(raw).alias("prompt"),
        messages.last_text(*_typed(raw, "chosen")).alias("chosen"),
        messages.last_text(*_typed(raw, "rejected")).alias("rejected"),
    )


def incomplete_rows(pairs: DataFrame) -> DataFrame:
    """Count of rows with a null field, per field: the rejects of pair building."""
    counts = pairs.agg(*[F.count_if(F.isnull(c)).alias(c) for c in pairs.columns])
    return counts.unpivot([], pairs.columns, "field", "rejects")


def render_chat_sft(df: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    return df.select(template.dialogue(F.col("prompt"), F.col("response")).alias("text"))


def render_chat_prompt(df: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    return df.withColumn("chat_prompt", messages.chat_prompt(F.col("prompt"), template))


def render_dpo_rows(df: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Templated prompt (raw without a template), stripped completions, nothing else."""
    prompt = F.col("prompt") if template is None else template.prompt(F.col("prompt"))
    return df.select(
        prompt.alias("prompt"),
        strip(F.col("chosen")).alias("chosen"),
        strip(F.col("rejected")).alias("rejected"),
    )


def clean_outputs(df: DataFrame, col: str = "raw", enabled: bool = True) -> DataFrame:
    return df.withColumn("cleaned", cleaning.clean(F.col(col)) if enabled else F.col(col))


def clean_triplets(df: DataFrame) -> DataFrame:
    """Strip the prompt and clean both completions before scoring."""
    return df.withColumns(
        {
            "prompt": strip(F.col("prompt")),
            "chosen": cleaning.clean(F.col("chosen")),
            "rejected": cleaning.clean(F.col("rejected")),
        }
    )


def rubric_scaffold(df: DataFrame) -> DataFrame:
    """Add the empty form for human ratings."""
    empty = F.from_json(F.lit('{"notes":""}'), schemas.RUBRIC)
    return df.withColumn("rubric", empty)


def cell(model: str, variant: str, value: Column) -> Column:
    """Aggregate: the value of one model and variant inside a group."""
    here = (F.col("model") == model) & (F.col("variant") == variant)
    return F.any_value(F.when(here, value), F.lit(True))


def by_model_and_variant(
    value: Column, models: tuple[str, ...] = MODELS, variants: tuple[str, ...] = VARIANTS
) -> Column:
    """Aggregate: nested record ``{model: {variant: value}}``.

    One slot per model and variant, filled by partial aggregation; unlike a
    collected list it cannot grow with the group.
    """
    return F.struct(
        *[
            F.struct(*[cell(m, v, value).alias(v) for v in variants]).alias(m)
            for m in models
        ]
    )


def assemble_items(
    prompts: DataFrame,
    generations: DataFrame,
    models: tuple[str, ...] = MODELS,
    variants: tuple[str, ...] = VARIANTS,
) -> DataFrame:
    """One row per prompt with its outputs by model and variant."""
    outputs = generations.groupBy("id").agg(
        by_model_and_variant(F.col("raw"), models, variants).alias("outputs")
    )
    return prompts.select("id", "category", "prompt").join(outputs, "id", "left")
