"""Seeded splits, samples and truncation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.operators.scale import hash_position, nth_position


def _test_rows(total: Column, n_samples: int) -> Column:
    """Size of the test part: 1.2 times the sample, between 2% and 20% of all."""
    share = F.lit(int(n_samples * 1.2)) / F.greatest(total, F.lit(1))
    share = F.greatest(F.lit(0.02), F.least(F.lit(0.2), share))
    return F.ceil(share * total)


def train_test_split(
    df: DataFrame, n_samples: int, seed: int = 42, key: str = "pair_id"
) -> DataFrame:
    """Add ``part``: the first rows of the seeded random order are 'test'."""
    last = nth_position(df, key, seed, lambda total: _test_rows(total, n_samples)).scalar()
    is_test = hash_position(F.col(key), seed) <= last
    return df.withColumn(
        "part", F.when(is_test, F.lit("test")).otherwise(F.lit("train"))
    )


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = "pair_id") -> DataFrame:
    """The first n rows of the seeded random order, all rows if there are fewer."""
    if n <= 0:
        return df.where(F.lit(False))
    last = nth_position(df, key, seed, lambda total: F.lit(n)).scalar()
    # No such row: the table has fewer than n
    return df.where(F.coalesce(hash_position(F.col(key), seed) <= last, F.lit(True)))


def head_n(df: DataFrame, n: int = 100, order: str = "row") -> DataFrame:
    """The first n rows by ``order``."""
    return df.orderBy(order).limit(n)


def truncate_tokens(df: DataFrame, k: int, tokens: str = "tokens") -> DataFrame:
    """Keep the first k tokens of a token array."""
    return df.withColumn(tokens, F.slice(tokens, 1, k))
