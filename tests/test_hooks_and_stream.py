"""Batch hooks and the stream, against the batch path."""

from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.operators import checks, hooks, ordering, preference
from plumbline.streaming import pass_rate


def test_generate_sees_whole_batches_once(spark):
    rows = [(f"p{i}", i, f"{i}", 1 + i % 13) for i in range(203)]
    df = spark.createDataFrame(rows, "id string, ord bigint, chat_prompt string, n_tokens bigint").repartition(9)
    batches = ordering.length_sorted_batches(df, batch_size=8)

    def load(model):
        def fn(prompts, variant):
            return [f"{model}/{variant}/{len(prompts)}/{p}" for p in prompts]

        return fn

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        out = hooks.batch_generate(batches, load, models=("base", "sft"), variants=("det", "samp")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(out) == len({(r.id, r.model, r.variant) for r in out}) == 203 * 4
    sizes = {r.raw.split("/")[2] for r in out}
    assert sizes == {"8", "3"}
    assert all(r.raw.endswith(f"/{r.id[1:]}") and r.raw.startswith(f"{r.model}/{r.variant}/") for r in out)


def test_score(spark):
    pairs = spark.createDataFrame([(f"k{i}", "a b", "c", "d e") for i in range(11)], "pair_id string, chat_prompt string, chosen string, rejected string")

    def load(model):
        def fn(prompts, completions):
            return [(len(p.split()), [-1.0] * len(f"{p} {c}".split())) for p, c in zip(prompts, completions)]

        return fn

    tokens = hooks.batch_score(pairs, load, models=("base",), batch_size=4)
    sums = {(r.pair_id, r.side): r.logp for r in preference.completion_loglik(tokens).collect()}
    assert sums == {(f"k{i}", s): v for i in range(11) for s, v in (("chosen", -1.0), ("rejected", -2.0))}


def test_stream_equals_batch(spark, tmp_path):
    listed = spark.createDataFrame([("p", [("exact_bullets", 1, None, None)]), ("q", [])], f"id string, checks {schemas.CHECKS}")
    answers = spark.createDataFrame(
        [(("p", "q")[i % 2], ("base", "sft")[i % 3 % 2], "det", ("- a", "x", None)[i % 3], i) for i in range(60)],
        "id string, model string, variant string, raw string, minute int",
    ).select("id", "model", "variant", "raw", F.timestamp_seconds(F.col("minute") * 600).alias("arrived"))
    static = checks.resolve_checks(listed.withColumn("prompt", F.lit(""))).select("id", "checks")
    streamed = {tuple(r) for r in pass_rate.replay(answers, static, str(tmp_path / "stream")).collect()}
    batch = pass_rate.windowed_pass_rate(pass_rate.judged_stream(answers, static))
    assert streamed == {tuple(r) for r in batch.collect()} and streamed
