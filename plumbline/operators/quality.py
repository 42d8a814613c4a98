"""Required-key checks over typed tables and raw JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def validate_required_keys(
    df: DataFrame,
    keys: Sequence[str],
    value: str | None = "value",
    row: str = "row",
    limit: int | None = None,
) -> DataFrame:
    """Per key: how many rows lack it and the first such row.

    With ``value`` the rows are JSON texts; a key that is there with a null
    value counts as there. With ``value=None`` the table is typed, so a column
    is there in all rows or in none. One pass, one output row per key.
    """
    if limit is not None:
        df = df.orderBy(row).limit(limit)
    if value is None:
        present = {k: F.lit(k in df.columns) for k in keys}
    else:
        df = df.select(row, F.json_object_keys(value).alias("_keys"))
        present = {
            k: F.coalesce(F.array_contains("_keys", k), F.lit(False)) for k in keys
        }
    stats = df.agg(
        *[
            F.struct(
                F.count_if(~here).cast("bigint").alias("missing"),
                F.min(F.when(~here, F.col(row))).cast("bigint").alias("first_row"),
            ).alias(f"_{i}")
            for i, here in enumerate(present.values())
        ]
    )
    records = F.array(
        *[
            F.struct(F.lit(k).alias("key"), F.col(f"_{i}.missing"), F.col(f"_{i}.first_row"))
            for i, k in enumerate(keys)
        ]
    )
    return stats.select(F.inline(records))


def schema_gate(df: DataFrame, key_sets: dict[str, Sequence[str]], **options) -> DataFrame:
    """The same for several named lists of required keys, in one pass."""
    keys = list(dict.fromkeys(k for ks in key_sets.values() for k in ks))
    sets = F.array(*[F.lit(name) for name in key_sets])
    members = F.create_map(
        *[x for name, ks in key_sets.items() for x in (F.lit(name), F.array(*map(F.lit, ks)))]
    )
    return (
        validate_required_keys(df, keys, **options)
        .withColumn("key_set", F.explode(sets))
        .where(F.array_contains(F.element_at(members, F.col("key_set")), F.col("key")))
        .select("key_set", "key", "missing", "first_row")
    )


def assert_required_keys(df: DataFrame, keys: Sequence[str], **options) -> None:
    """Raise on the first row that lacks a key. Brings back one row at most."""
    order = F.array_position(F.array(*map(F.lit, keys)), F.col("key"))
    found = (
        validate_required_keys(df, keys, **options)
        .where(F.col("missing") > 0)
        .orderBy("first_row", order)
        .first()
    )
    if found:
        raise AssertionError(f"Missing key '{found.key}' in row {found.first_row}")
