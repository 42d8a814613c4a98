"""Building blocks that keep large or skewed tables spread over the cluster."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from plumbline import settings
from plumbline.functions.hashing import seeded_hash

_SPAN_BITS = 21
_HASH_BITS = 60
_BUCKET_BITS = 20

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    value: Column,
    out: str,
    descending_groups: bool = False,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows that come earlier.

    Earlier means a smaller ``order`` inside the same group; with
    ``descending_groups`` also every row of a group that sorts higher, so that
    one order runs over the whole table. ``order`` is a unique whole number.

    No window ever holds a whole group. The order key is cut into ranges of
    2**21 values, which a unique key can fill with at most 2**21 rows. Sums per
    range are taken by partial aggregation; prefix sums over those small tables
    give each range its offset, and only the rows of one range are windowed
    together. One group may hold most of the table. A range is sorted in one
    task, so pass keys and lengths and leave long texts out.
    """
    if not isinstance(df.schema[order].dataType, _INTEGRAL):
        raise TypeError(f"{order} must be a whole number")
    key = F.col(order).cast("bigint")
    key = F.when(
        F.isnull(key), F.raise_error(F.lit(f"{order} is null")).cast("bigint")
    ).otherwise(key)
    # Never null, so that no null filter makes the uses of ``fine`` differ and
    # its shuffle is shared by them.
    key = F.coalesce(key, F.lit(0))
    group_key = F.struct(*group) if group else F.lit(0)
    keyed = df.select(
        "*",
        group_key.alias("_group"),
        F.shiftright(key, 2 * _SPAN_BITS).alias("_coarse"),
        F.shiftright(key, _SPAN_BITS).alias("_fine"),
        value.cast("bigint").alias("_value"),
    )

    fine = keyed.groupBy("_group", "_coarse", "_fine").agg(F.sum("_value").alias("_sum"))
    coarse = fine.groupBy("_group", "_coarse").agg(F.sum("_sum").alias("_sum"))

    def before(column: str, over) -> Column:
        earlier = over.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    offsets = fine.select(
        "_group",
        "_coarse",
        "_fine",
        before("_sum", Window.partitionBy("_group", "_coarse").orderBy("_fine")).alias("_before_fine"),
    ).join(
        coarse.select(
            "_group",
            "_coarse",
            before("_sum", Window.partitionBy("_group").orderBy("_coarse")).alias("_before_coarse"),
        ),
        ["_group", "_coarse"],
    )
    offset = F.col("_before_fine") + F.col("_before_coarse")
    if descending_groups:
        totals = coarse.groupBy("_group").agg(F.sum("_sum").alias("_sum"))
        offsets = offsets.join(
            totals.select(
                "_group",
                before("_sum", Window.partitionBy(F.lit(0)).orderBy(F.desc("_group"))).alias(
                    "_before_group"
                ),
            ),
            "_group",
        )
        offset = offset + F.col("_before_group")
    offsets = offsets.select("_group", "_coarse", "_fine", offset.alias("_offset"))

    in_range = Window.partitionBy("_group", "_coarse", "_fine").orderBy(order)
    return (
        keyed.join(offsets, ["_group", "_coarse", "_fine"])
        .withColumn(out, (F.col("_offset") + before("_value", in_range)).cast("bigint"))
        .drop("_group", "_coarse", "_fine", "_value", "_offset")
    )


def lookup_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join with a table that holds each key once, where one key may be very hot.

    Spark broadcasts ``small`` when its size allows. Otherwise the adaptive skew
    join splits the rows of a hot key over tasks and repeats the one matching
    row. It can do so only when each side comes straight out of a shuffle of its
    own. A ``small`` that is an aggregate is already partitioned by its keys and
    would be joined in place; the key is therefore wrapped in a record.
    """
    settings.ensure(big.sparkSession)
    present = reduce(Column.__and__, [F.isnotnull(k) for k in keys])
    key = F.when(present, F.struct(*keys))
    left = big.withColumn("_key", key)
    right = small.withColumn("_key", key).drop(*keys)
    return left.join(right, "_key", how).drop("_key")


def hash_position(key: Column, seed: int) -> Column:
    """Place of a row in the seeded random order: hash first, key to break ties."""
    return F.struct(seeded_hash(key, seed).alias("h"), key.alias("k"))


def nth_position(
    df: DataFrame, key: str, seed: int, wanted: Callable[[Column], Column]
) -> DataFrame:
    """One row with the place of the ``wanted(total)``-th row in the seeded order.

    No row when that many do not exist. Rows are counted in 2**20 hash buckets
    by partial aggregation; only the one bucket that the wanted row falls into
    is sorted. ``key`` is unique.
    """
    keyed = df.select(F.col(key).alias("k"), seeded_hash(F.col(key), seed).alias("h")).withColumn(
        "b", F.shiftright("h", _HASH_BITS - _BUCKET_BITS)
    )
    all_buckets = Window.partitionBy(F.lit(0))
    upto = F.sum("n").over(all_buckets.orderBy("b"))
    total = F.sum("n").over(all_buckets)
    buckets = (
        keyed.groupBy("b")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("b", "n", upto.alias("upto"), wanted(total).cast("bigint").alias("wanted"))
    )
    edge = buckets.where(
        (F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted"))
    ).select("b", (F.col("wanted") - (F.col("upto") - F.col("n"))).alias("rest"))
    in_bucket = F.row_number().over(Window.partitionBy("b").orderBy("h", "k"))
    return (
        keyed.join(F.broadcast(edge), "b")
        .withColumn("rn", in_bucket)
        .where(F.col("rn") == F.col("rest"))
        .select(F.struct("h", "k").alias("place"))
    )
