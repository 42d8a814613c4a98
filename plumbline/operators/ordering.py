"""Length order, batches, packing and buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plumbline.operators.scale import running_total


def length_sorted_order(
    df: DataFrame, length: str = "n_tokens", ord: str = "ord", max_length: int | None = None
) -> DataFrame:
    """Add ``rank`` from 1: longest first, ties in original order.

    Prompts are cut to ``max_length`` before they are ordered: longer ones have
    that length, so they tie and keep their order.
    """
    if max_length is not None:
        df = df.withColumn(length, F.least(F.col(length), F.lit(max_length).cast("bigint")))
    return running_total(
        df, [length], ord, F.lit(1), "rank", descending_groups=True
    ).withColumn("rank", F.col("rank") + F.lit(1))


def restore_order(df: DataFrame, ord: str = "ord") -> DataFrame:
    """Back to the original order. A range-partitioned sort, not one task."""
    return df.orderBy(ord)


def length_sorted_batches(
    df: DataFrame,
    length: str = "n_tokens",
    ord: str = "ord",
    batch_size: int = 8,
    multiple: int = 8,
    max_length: int | None = None,
) -> DataFrame:
    """Cut the length order into batches and pad each to its longest row.

    No row is padded beyond ``max_length`` rounded up.

    The window holds ``batch_size`` rows; its shuffle by ``batch_id`` is the
    one a batch hook needs anyway.
    """
    ranked = length_sorted_order(df, length, ord, max_length).withColumn(
        "batch_id", F.floor((F.col("rank") - 1) / batch_size).cast("bigint")
    )
    longest = F.max(length).over(Window.partitionBy("batch_id"))
    padded = (F.ceil(longest / multiple) * multiple).cast("bigint")
    return ranked.withColumn("padded_len", padded).withColumn(
        "waste", (F.col("padded_len") - F.col(length)).cast("bigint")
    )


def pack_sequences(
    df: DataFrame,
    block: int = 512,
    length: str = "n_tokens",
    ord: str = "ord",
    shard: str | None = None,
) -> DataFrame:
    """Lay sequences end to end and cut blocks of fixed size.

    One row per sequence and block: the tokens [from, to) of the sequence that
    lie in the block. With ``shard`` each shard has its own run of blocks.
    """
    group = [shard] if shard else []
    start, n = F.col("_start"), F.col(length)
    placed = running_total(df, group, ord, n, "_start")
    first = F.floor(start / block).cast("bigint")
    last = F.floor((start + n - 1) / block).cast("bigint")
    # Empty sequences lie in no block. They go after the placement, as a filter
    # on the length before it would take the length twice where it is computed.
    blocks = F.when(n > 0, F.sequence(first, last))
    cut = placed.withColumn("block_id", F.explode_outer(blocks)).where(F.isnotnull("block_id"))
    begin = F.col("block_id") * block - start
    return cut.withColumns(
        {
            "from": F.greatest(begin, F.lit(0)).cast("bigint"),
            "to": F.least(begin + block, n).cast("bigint"),
        }
    ).drop("_start")


def length_buckets(df: DataFrame, width: int, length: str = "n_tokens") -> DataFrame:
    """Add the length bucket; rows of like length get like numbers."""
    return df.withColumn("bucket", F.floor(F.col(length) / width).cast("bigint"))


def group_by_bucket(df: DataFrame, ord: str = "ord") -> DataFrame:
    """Place rows of like length together; one large bucket spans many tasks."""
    return df.repartitionByRange("bucket", ord).sortWithinPartitions("bucket", ord)
