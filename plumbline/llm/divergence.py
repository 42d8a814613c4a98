"""Source divergence audit: how far each source's term distribution lies from the others of its language.

Identical texts of a language are collapsed first, with how many rows of each
source hold them; each distinct text is tokenized once, and the weighted
document frequencies and term counts are added from there. Pairs of sources are
then evaluated sparsely: only terms that occur in a source are ever rows, and
the terms that occur in neither side of a pair are accounted for by one product.
All arithmetic is on whole numbers (decimals where a product could pass 64 bits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import stored

# Fixed values of the contract: the term pattern, the least number of documents
# of a language that hold a kept term, the scale of p, the ranks kept of part term.
TERM = "[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: What lies between terms: the complement, split on (much cheaper than extracting matches).
BETWEEN = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def p_value(count: str, total: str, kept: str) -> Column:
    """p = 1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact (``div`` of decimals)."""
    return F.expr(
        f"1 + (cast({count} + 2 AS decimal(38,0)) * {SCALE}) div cast({total} + 2 * {kept} AS decimal(38,0))"
    )


def f_value(p: str, q: str) -> Column:
    """f = floor((p - q)^2 / (p + q)); p and q are at least 1 and at most SCALE + 1."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, term, count, docs`` of kept terms, ``count > 0``: occurrences and rows holding it.

    Null text, lang and source read as ''. A term is kept in a language when at
    least ``least_docs`` of its rows hold it. Identical texts of a language are
    one row before tokenizing, keyed by two 64-bit hashes of the text, with the
    number of rows of each source; copies of any count are thus tokenized once
    and collapse map-side before any shuffle.
    """
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select("lang", "source", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("k2"), "text").alias("k2"))
    copies = rows.groupBy("lang", "k1", "k2", "source").agg(F.count(F.lit(1)).alias("m"))
    texts = rows.select("lang", "k1", "k2", "text").dropDuplicates(["lang", "k1", "k2"])
    # Maximal runs of term characters are the pieces between maximal runs of the
    # others; a separator at either end leaves an empty piece, which is no term.
    # An all-ASCII text (as many characters as bytes) is lower-cased by lower(),
    # which then changes A-Z only and is several times cheaper than translate().
    ascii_only = F.length("text") == F.octet_length("text")
    lowered = F.when(ascii_only, F.lower("text")).otherwise(F.translate("text", _UPPER, _LOWER))
    words = F.split(lowered, BETWEEN)
    tf = (
        texts.select("lang", "k1", "k2", F.explode(words).alias("term"))
        .where(F.length("term") > 0)
        .groupBy("lang", "k1", "k2", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    counts = (
        tf.join(copies, ["lang", "k1", "k2"])
        .groupBy("lang", "source", "term")
        .agg(F.sum(F.col("tf") * F.col("m")).alias("count"), F.sum("m").alias("docs"))
    )
    # A window has one row per source that holds the term, so the counts cross one
    # shuffle to be filtered and need not be stored before.
    held = F.sum("docs").over(Window.partitionBy("lang", "term"))
    kept = counts.withColumn("_held", held).where(F.col("_held") >= least_docs).drop("_held")
    return stored(kept, "divergence_kept")


def groups(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, source, n, v``: every occurring group, its total of kept counts and its language's V."""
    present = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
    ).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    sizes = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    return (
        present.join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    )


def _ranked(df: DataFrame, limit: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item").asc())
    ranked = df.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= limit) if limit else ranked


def term_part(counts: DataFrame, sizes: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """Kept terms of a group with count > 0 whose p exceeds the language's; the ``top`` largest f."""
    lang = counts.groupBy("lang", "term").agg(F.sum("count").alias("lc"))
    lang_n = sizes.groupBy("lang").agg(F.sum("n").alias("ln"), F.first("v").alias("lv"))
    rows = (
        counts.join(sizes, ["lang", "source"])
        .join(lang, ["lang", "term"])
        .join(lang_n, "lang")
        .select("lang", "source", "term", p_value("count", "n", "v").alias("p"), p_value("lc", "ln", "lv").alias("q"))
        .where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), f_value("p", "q").alias("value"))
    )
    return _ranked(rows, top)


def pair_part(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """For each ordered pair of sources of a language, f summed over all kept terms.

    With T_s the terms of s (count > 0), p0 the p of count 0 and X = T_s ∩ T_t:
    sum = Σ_X f(p_s, p_t) + Σ_{T_s \\ X} f(p_s, p0_t) + Σ_{T_t \\ X} f(p0_s, p_t)
    + (V - |T_s| - |T_t| + |X|) f(p0_s, p0_t). The one-sided sums run over a
    histogram of counts per source, the intersection over a join on the term,
    whose rows are summed in the same stage (partial aggregation) and never
    shuffled. Rows per term are bounded by the sources that hold it.
    """
    base = sizes.select("lang", "source", "n", "v", F.when(F.col("v") > 0, p_value("0", "n", "v")).alias("p0"))
    other = base.select("lang", *(F.col(c).alias(f"t_{c}") for c in ("source", "n", "p0")))
    pairs = base.join(other, "lang").where(F.col("source") != F.col("t_source"))

    # Σ over T_s of f(p_s, p0_t), by the histogram of counts of s.
    histogram = counts.groupBy("lang", "source", "count").agg(F.count(F.lit(1)).alias("terms"))
    one_sided = (
        histogram.join(pairs, ["lang", "source"])
        .select("lang", "source", "t_source", "terms", p_value("count", "n", "v").alias("p"), "t_p0")
        .groupBy("lang", "source", "t_source")
        .agg(F.sum(F.col("terms") * f_value("p", "t_p0")).alias("full"), F.sum("terms").alias("size"))
    )

    # Terms held by both: f of both p, less what the one-sided sums counted for them.
    mine = counts.join(base, ["lang", "source"]).select("lang", "term", "source", p_value("count", "n", "v").alias("p"), "p0")
    theirs = mine.select("lang", "term", *(F.col(c).alias(f"t_{c}") for c in ("source", "p", "p0")))
    both = (
        mine.join(theirs, ["lang", "term"])
        .where(F.col("source") != F.col("t_source"))
        .groupBy("lang", "source", "t_source")
        .agg(
            F.sum(f_value("p", "t_p") - f_value("p", "t_p0") - f_value("p0", "t_p")).alias("shared"),
            F.count(F.lit(1)).alias("common"),
        )
    )
    mirrored = one_sided.select(
        "lang", F.col("t_source").alias("source"), F.col("source").alias("t_source"),
        F.col("full").alias("t_full"), F.col("size").alias("t_size"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    value = F.when(
        F.col("v") > 0,
        zero("full") + zero("t_full") + zero("shared")
        + (F.col("v") - zero("size") - zero("t_size") + zero("common")) * f_value("p0", "t_p0"),
    ).otherwise(F.lit(0))
    rows = (
        pairs.join(one_sided, ["lang", "source", "t_source"], "left")
        .join(mirrored, ["lang", "source", "t_source"], "left")
        .join(both, ["lang", "source", "t_source"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), F.col("t_source").alias("item"), value.cast("bigint").alias("value"))
    )
    return _ranked(rows, None)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every occurring (lang, source) group of ``docs``.

    Reads ``text, lang, source``; other columns, even of clashing names, are not
    read. Null text, lang and source read as ''. Part ``pair``: one row per other
    source of the language (none when the language has one source), value 0 when
    the language keeps no term; a group without kept terms still has its rows.
    Part ``term``: the ``top`` kept terms whose p in the group exceeds the
    language's, value f. Ranks count from 1 per group and part, by value
    descending, then item by UTF-8 bytes; ties of both cannot occur (items are
    distinct). Repeated rows count as documents each. An empty table gives no rows.
    """
    counts = term_counts(docs, least_docs)
    sizes = stored(groups(docs, counts), "divergence_groups")
    return pair_part(counts, sizes).unionByName(term_part(counts, sizes, top)).select(
        "lang", "source", "part", "item", F.col("value").cast("bigint"), F.col("rank").cast("int")
    )
