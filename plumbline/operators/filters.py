"""Row filters. All are plain predicates, so they reach the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F


def skip_categories(df: DataFrame, categories: Iterable[str] = ("safety_harm",)) -> DataFrame:
    """Drop the listed categories; rows without a category stay."""
    listed = list(categories)
    if not listed:
        return df
    category = F.col("category")
    return df.where(F.isnull(category) | ~category.isin(listed))


def drop_missing_outputs(df: DataFrame) -> DataFrame:
    return df.where(F.isnotnull("raw"))


def select_variant(df: DataFrame, variant: str = "det") -> DataFrame:
    return df.where(F.col("variant") == variant)


def skip_absent_models(df: DataFrame, supplied: Iterable[str] = ()) -> DataFrame:
    """The base model always takes part, the others only when supplied."""
    return df.where(F.col("model").isin(["base", *supplied]))


def applicable_only(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(F.isnotnull("pass_all"))
