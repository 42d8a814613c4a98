"""What the plans look like, and what happens with one very hot key."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from plumbline import schemas
from plumbline.operators import checks, joins, preference, summary
from plumbline.plans import catalog, derived, format_eval

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The adaptive plan after a run."""
    jdf = df._jdf
    jdf.collectToPython() if hasattr(jdf, "collectToPython") else jdf.count()
    return jdf.queryExecution().executedPlan().toString()


HOOKS = {"batch_generate", "batch_score"}
STORED = {n for n in catalog.QUERIES if n.startswith(("src_", "sink_", "stream_"))}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - STORED))
def test_no_cross_join_no_python(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert ("InPandas" in text) == (name in HOOKS)
    assert "PythonUDF" not in text.replace("MapInPandas", "")


def test_scan_reads_needed_columns_and_filters(spark):
    text = plan(catalog.QUERIES["skip_categories"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint>" in text
    text = plan(derived.pref_pairs(spark, SF))
    assert "EqualTo(role,assistant)" in text


def test_prompt_text_is_not_joined_to_answers(spark):
    prompts, answers = derived.prompts(spark, SF), derived.generations(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = checks.verdicts(format_eval.evaluated_answers(prompts, answers))
        joined = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below_join = joined.split("Join Inner")[1]
    carried = re.search(r"Project \[(.*)\]", below_join).group(1)
    assert "prompt#" not in carried.split(" AS ")[-1]


def hot(spark):
    """One prompt holds most answers."""
    ids = F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 50))
    answers = spark.range(0, 60_000, 1, 12).select(
        ids.alias("id"),
        F.lit("base").alias("model"),
        F.col("id").cast("string").alias("variant"),
        F.concat(F.lit("- "), F.sha2(F.col("id").cast("string"), 512)).alias("raw"),
    )
    listed = F.array(derived._check("exact_bullets", "1")).cast(schemas.CHECKS)
    prompts = answers.select("id").distinct().select(
        "id", F.lit("x").alias("category"), F.lit("").alias("prompt"), listed.alias("checks")
    )
    return prompts, answers


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_thresholds(spark):
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k in SKEW:
        spark.conf.unset(k)


def test_hot_prompt_is_split(spark, small_thresholds):
    prompts, answers = hot(spark)
    done = format_eval.evaluated_answers(prompts, answers)
    assert "skew=true" in final_plan(checks.verdicts(done))
    # also where an aggregation by the same key follows
    per_id = checks.verdicts(done).groupBy("id").agg(F.count_if("pass_all").alias("n"))
    assert "skew=true" in final_plan(per_id)
    assert per_id.agg(F.sum("n")).first()[0] == 60_000


def test_hot_word_is_split(spark, small_thresholds):
    texts = spark.range(0, 4000, 1, 12).select("id", F.concat(F.repeat(F.lit("the "), 60), F.col("id")).alias("text"))
    texts = texts.withColumn("id", F.sha2(F.col("id").cast("string"), 512))
    tokens = preference.word_tokens(texts, ["id"])
    scored = preference.ngram_token_logp(tokens, tokens)
    assert "skew=true" in final_plan(scored)
    assert scored.count() == 4000 * 61


def test_wins_need_no_window(spark):
    done = format_eval.evaluated_answers(derived.prompts(spark, SF), derived.generations(spark, SF))
    text = plan(summary.wins_and_ties(checks.verdicts(done)))
    assert "Window" not in text
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_entry_contract():
    assert set(catalog.QUERIES) <= set(contract.queries()) & set(contract.oracle_sql())


def test_each_answer_is_judged_once(spark):
    done = format_eval.evaluated_answers(derived.prompts(spark, SF), derived.generations(spark, SF))
    for df in (
        checks.verdicts(done).where("pass_all is not null"),
        checks.check_results(done),
        summary.eval_summary(done),
    ):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("unknown_check:") == 1


def test_replay_keeps_repeated_requests(spark):
    items = spark.sql(
        "SELECT 'a' AS id, 'p' AS prompt, 'base' AS model, 'det' AS variant, 'o' AS raw, "
        "named_struct('pass_all', true, 'checks', '[]') AS verdict"
    )
    requests = spark.createDataFrame([("a", "det")] * 3 + [("b", "det")], "id string, variant string")
    prompts = spark.createDataFrame([("a", "p"), ("c", "q")], "id string, prompt string")
    requests = requests.union(spark.createDataFrame([("c", "det")], requests.schema))
    rows = joins.replay_lookup(prompts, items.drop("prompt"), requests).orderBy("id").collect()
    assert [r.id for r in rows] == ["a", "a", "a", "c"]
    assert (rows[3].prompt, rows[3].base) == ("q", None)
    assert rows[3].eval_text == "**Base:** N/A\n\n**SFT:** N/A\n\n**DPO:** N/A\n"
    assert [tuple(r) for r in joins.unknown_requests(prompts, requests).collect()] == [("b", 1)]
    assert rows[0].eval_text == "**Base:** pass_all=True | checks=[]\n\n**SFT:** N/A\n\n**DPO:** N/A\n"
