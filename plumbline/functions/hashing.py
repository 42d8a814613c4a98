"""Seeded hashes that are equal on every cluster and in any SQL engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash32(c: Column) -> Column:
    """First 8 hexadecimal digits of md5 as BIGINT."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")


def seeded_hash(key: Column, seed: int) -> Column:
    """60-bit hash of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
