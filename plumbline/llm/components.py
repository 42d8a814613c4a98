"""Connected components of a large edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import stored
from plumbline.operators.scale import lookup_join


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node in ``edges (a, b)``.

    Large stars hang all larger neighbours of a node on the smallest one, small
    stars the rest; a few rounds leave one star per component. Each round is a
    pair of aggregations and joins over a table that never outgrows its input;
    it is written to the shared folder, which cuts the lineage. Nothing but a
    count and a checksum reaches the driver. Loops and nulls are left out.
    """
    now = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(rounds):
        state = now.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v").distinct()
            )
        seen = state
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = lookup_join(both.where("v > u"), least, ["u"]).select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")
        )
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup_join(large, least, ["u"]).where("v <> m").select(F.col("v").alias("u"), "m")
        now = stored(small.union(least).distinct().toDF("u", "v"), "edges")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
