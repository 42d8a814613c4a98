"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree.

Every source's documents are put in a seeded random order and cut into blocks.
The blocks that a source owes (whole passes and a rest) are its quota. A tree
halves the quotas, exactly, by multivariate-hypergeometric draws until each leaf
is an output shard. A shard's share of a source is then the next blocks of the
random order, disjoint from those of all other shards, and its rows are
shuffled within the shard. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import WORD, stored
from plumbline.operators.scale import lookup_join

#: Weights by place in the order of sources, largest multiple of a source.
WEIGHTS, MOST = (1, 2, 3), 3
#: Words per block and (about) per output shard.
BLOCK_WORDS, SHARD_WORDS = 50_000, 4_000_000
SEED = 20_240
#: Hash ranges that a source is cut into, so that no window holds a whole source.
_RANGES = 1 << 14


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target``: words each source should give.

    ``sizes`` has ``source, size``. Sources in code point order, null last,
    weigh 1, 2, 3 and so on again. They share the sum of all sizes by weight,
    but none beyond three times its own size; the excess is shared anew by
    weight. The fixed point is ``least(cap, level * weight)``: sources are
    capped in the order of cap by weight, and the level follows from prefix
    sums. One row per source is windowed in one task.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source"))
    weights = F.array(*map(F.lit, WEIGHTS))
    rows = by_source.withColumn("w", F.element_at(weights, ((place - 1) % len(WEIGHTS) + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * MOST)
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.sum("w").over(all_rows) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    # The level that holds if this source is the first that stays below its cap; the
    # levels only fall from the true first one on.
    rows = rows.withColumn("level", level).withColumn("below", F.col("level") * F.col("w") <= F.col("cap"))
    level = F.max(F.when(F.col("below"), F.col("level"))).over(all_rows)
    return rows.select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("w")).alias("target"),
    )


def _uniform(*parts: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once; keeps nested expressions small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _drawn(total: Column, own: Column, take: Column, u: Column) -> Column:
    """Hypergeometric draw by inversion: how many of ``own`` among ``take`` out of ``total``.

    Weights are relative to the mode and reach ten standard deviations to
    either side, beyond which they are below the resolution of a double.
    """

    def up(a, x: Column) -> Column:
        """Weight of x + 1 over weight of x is up / down; both are at least 1 inside the range."""
        return F.greatest((a["k"] - x) * (a["n"] - x), F.lit(1.0))

    def down(a, x: Column) -> Column:
        return F.greatest((x + 1) * (a["t"] - a["k"] - a["n"] + x + 1), F.lit(1.0))

    def bounded(a) -> Column:
        t, k, n = a["t"], a["k"], a["n"]
        variance = n * k * (t - k) * (t - n) / F.greatest(t * t * (t - 1), F.lit(1.0))
        return F.struct(
            F.greatest(F.lit(0.0), n - (t - k)).alias("low"),
            F.least(n, k).alias("high"),
            F.floor((n + 1) * (k + 1) / (t + 2)).cast("double").alias("mode"),
            (F.ceil(10 * F.sqrt(F.greatest(variance, F.lit(0.0)))).cast("double") + 10).alias("reach"),
        )

    def in_range(b) -> Column:
        mode = F.greatest(b["low"], F.least(b["high"], b["mode"]))
        first, last = F.greatest(b["low"], mode - b["reach"]), F.least(b["high"], mode + b["reach"])
        steps = F.transform(F.sequence(first.cast("bigint"), last.cast("bigint")), lambda x: x.cast("double"))
        return F.struct(mode.alias("mode"), last.alias("last"), steps.alias("steps"))

    def lowest(a, c) -> Column:
        return F.aggregate(
            c["steps"],
            F.lit(1.0),
            lambda w, x: F.when(x < c["mode"], w * down(a, x) / up(a, x)).otherwise(w),
        )

    def walk(a, c, weight: Column, until: Column, result: str) -> Column:
        start = F.struct(weight.alias("w"), F.lit(0.0).alias("sum"), c["last"].alias("x"), F.lit(False).alias("found"))

        def step(s, x):
            reached = s["sum"] + s["w"]
            return F.struct(
                (s["w"] * up(a, x) / down(a, x)).alias("w"),
                reached.alias("sum"),
                F.when((reached >= until) & ~s["found"], x).otherwise(s["x"]).alias("x"),
                (s["found"] | (reached >= until)).alias("found"),
            )

        return F.aggregate(c["steps"], start, step, lambda s: s[result])

    def inverted(a, c) -> Column:
        return _let(
            lowest(a, c),
            lambda w: _let(
                a["u"] * walk(a, c, w, F.lit(float("inf")), "sum"), lambda until: walk(a, c, w, until, "x")
            ),
        )

    given = (total.cast("double").alias("t"), own.cast("double").alias("k"), take.cast("double").alias("n"))
    drawn = _let(
        F.struct(*given, u.alias("u")),
        lambda a: _let(bounded(a), lambda b: _let(in_range(b), lambda c: inverted(a, c))),
    )
    return drawn.cast("bigint")


def _left_quotas(seed: int, level: int) -> Column:
    """The left child's quotas: half of the node's blocks, source by source given those before."""
    total = F.aggregate("quota", F.lit(0).cast("bigint"), lambda a, q: a + q)
    start = F.struct(
        F.array().cast("array<bigint>").alias("out"),
        total.alias("total"),
        F.floor(total / 2).cast("bigint").alias("take"),
    )

    def step(s, q):
        u = _uniform(F.lit(seed), F.lit(level), F.col("shard"), F.size(s["out"]))
        x = F.when((q == 0) | (s["take"] == 0), F.lit(0).cast("bigint")).otherwise(
            _drawn(s["total"], q, s["take"], u)
        )
        return F.struct(
            F.concat(s["out"], F.array(x)).alias("out"),
            (s["total"] - q).alias("total"),
            (s["take"] - x).alias("take"),
        )

    return F.aggregate("quota", start, step, lambda s: s["out"])


def splitting_tree(quotas: DataFrame, depth: int, seed: int = SEED) -> DataFrame:
    """``source, shard, first, blocks``: which block slots of a source a shard gets.

    ``quotas`` has ``source, quota``. One row holds the quotas of a node, in
    source order; each level draws the left child's quotas, one source after
    the other given those before, and leaves the right child the rest. Sums
    are kept exactly. Rows: one per node, 2**depth at the end.
    """
    ordered = F.array_sort(
        F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "quota"))
    )
    # One entry per source; no data rows.
    node = quotas.groupBy().agg(ordered.alias("s")).select(
        F.lit(0).cast("bigint").alias("shard"),
        F.col("s.source").alias("sources"),
        F.col("s.quota").alias("quota"),
    )
    for level in range(depth):
        left = _left_quotas(seed, level)
        halves = node.select("shard", "sources", "quota", left.alias("left")).select(
            "sources",
            F.explode(
                F.array(
                    F.struct((F.col("shard") * 2).alias("shard"), F.col("left").alias("quota")),
                    F.struct(
                        (F.col("shard") * 2 + 1).alias("shard"),
                        F.zip_with("quota", "left", lambda q, x: q - x).alias("quota"),
                    ),
                )
            ).alias("n"),
        )
        node = halves.select("n.shard", "sources", "n.quota")
        if level == 8:
            node = node.repartition("shard")
    shares = node.select("shard", F.explode(F.arrays_zip("sources", "quota")).alias("e")).select(
        F.col("e.sources").alias("source"), "shard", F.col("e.quota").alias("blocks")
    )
    earlier = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shares.select(
        "source", "shard", F.coalesce(F.sum("blocks").over(earlier), F.lit(0)).alias("first"), "blocks"
    ).where("blocks > 0")


def _in_random_order(sizes: DataFrame, seed: int) -> DataFrame:
    """``sizes`` with ``start``: words of the source that come before the row in its random order.

    The order is that of a seeded hash of id and content. Sums per source and
    hash range come from partial aggregation and are summed up to offsets; only
    the rows of one range are sorted together.
    """
    keyed = sizes.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "content")).withColumn(
        "range", F.pmod(F.shiftrightunsigned("h", 50), F.lit(_RANGES))
    )
    keyed = keyed.withColumn("key", _source_key())
    ranges = keyed.groupBy("key", "range").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("key", "range", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("offset"))
    within = Window.partitionBy("key", "range").orderBy("h", "doc_id", "content", "rid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        keyed.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(offsets, ["key", "range"])
        .withColumn("start", F.col("offset") + F.col("inner"))
        .drop("h", "range", "inner", "offset", "source")
    )


def _source_key() -> Column:
    """A source as a join key that keeps null apart from the empty name."""
    return F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))


def plan_mix(
    sizes: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """What the mix takes of every row of ``sizes (doc_id, content, source, size, rid)``.

    Adds ``source_size``, ``target`` and ``shards``: the output shard of each
    time the row is taken, up to three, none for a row the rest does not reach.
    A source gives whole passes and, for the rest, the start of its random
    order, cut at the document nearest to the target. ``content`` tells rows
    with equal ids apart, ``rid`` equal rows. Sizes of zero are taken whenever
    their place is; an empty table gives an empty plan.
    """
    blocks = F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)).cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    wanted = targets(sizes).withColumn("blocks", blocks).withColumn("passes", passes.cast("bigint"))
    wanted = stored(
        wanted.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "targets"
    )
    total = wanted.agg(F.sum("target")).first()[0] or 0.0
    quotas = wanted.select(
        "source",
        (F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words).cast("bigint")).alias("quota"),
    )
    shares = splitting_tree(quotas, (int(total) // shard_words).bit_length(), seed)
    by_source = wanted.withColumn("key", _source_key()).drop("source")
    slots = shares.select(
        _source_key().alias("key"),
        "shard",
        F.explode(F.sequence("first", F.col("first") + F.col("blocks") - 1)).alias("slot"),
    )
    # A block is drawn once in each pass: at most three shards.
    drawn = (
        slots.join(by_source.select("key", "blocks"), "key")
        .groupBy("key", (F.col("slot") % F.col("blocks")).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("slot", "shard")))["shard"].alias("drawn"))
    )
    rows = lookup_join(_in_random_order(sizes, seed), by_source, ["key"])
    block = F.least(F.floor(F.col("start") / block_words).cast("bigint"), F.col("blocks") - 1)
    times = F.col("passes") + F.when(F.col("start") + F.col("size") / 2 < F.col("rest"), 1).otherwise(0)
    rows = rows.select("*", block.alias("block"), times.cast("int").alias("times"))
    none = F.array().cast("array<bigint>")
    return (
        lookup_join(rows, drawn, ["key", "block"], "left")
        .withColumn("shards", F.slice(F.coalesce("drawn", none), F.lit(1), F.col("times")))
        .select(*[c for c in sizes.columns if c != "source"], "source_size", "target", "shards")
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs (doc_id, text, source)``: size, its source's size and target, words taken."""
    sizes = stored(
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("content"),
            "source",
            n_words("text").alias("size"),
            F.lit(0).alias("rid"),
        ),
        "sizes",
    )
    return plan_mix(sizes).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("shards")).cast("bigint").alias("taken"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, columns unchanged, repeated as often as taken.

    Rows lie by shard, in a random order within it.
    """
    rid, shard, size = "_rid_of_mix", "_shard_of_mix", "_size_of_mix"
    rows = stored(
        docs.withColumn(size, n_words("text")).withColumn(rid, F.monotonically_increasing_id()), "rows"
    )
    sizes = rows.select(
        "doc_id",
        F.xxhash64("text").alias("content"),
        "source",
        F.col(size).alias("size"),
        F.col(rid).alias("rid"),
    )
    plan = plan_mix(sizes).where(F.size("shards") > 0).select(F.col("rid").alias(rid), "shards")
    taken = rows.join(plan.withColumnRenamed("shards", "_shards_of_mix"), rid)
    order = F.xxhash64(F.lit(SEED), shard, "doc_id", F.col("_pass_of_mix"))
    return (
        taken.select(*docs.columns, F.posexplode("_shards_of_mix").alias("_pass_of_mix", shard))
        .repartition(shard)
        .sortWithinPartitions(F.col(shard), order)
        .select(*docs.columns)
    )
