"""Cases that must not turn into a verdict by chance."""

from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.operators import checks, ordering, summary
from plumbline.sources import readers


def judged(spark, listed, answer):
    df = spark.createDataFrame([("p", "", listed, answer)], f"id string, prompt string, checks {schemas.CHECKS}, cleaned string")
    return checks.evaluate(df).first()


def test_a_check_without_its_number_is_not_booked(spark):
    for kind in ("exact_bullets", "first_n_lines_questions"):
        r = judged(spark, [(kind, None, None, None)], "- a\nWhy?")
        assert (r.results[0].reason, r.results[0]["pass"], r.pass_all, r.n_passed) == ("missing_n", None, None, 0)
    r = judged(spark, [("exact_bullets", None, None, None), ("exact_bullets", 2, None, None)], "- a")
    assert r.pass_all is False
    rows = spark.createDataFrame(
        [("base", "exact_bullets", None), ("base", "exact_bullets", True)], "model string, type string, pass boolean"
    )
    assert [(r.passed, r.total) for r in summary.per_check_rate(rows).collect()] == [(1, 1)]


def test_numbers_beyond_the_integer_range(spark):
    texts = ["exactly 99999999999 bullets", "exactly 99999999999 bullets, in 2 bullets", "in 2 bullets", f"exactly {'9' * 40} bullets"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, prompt string")
    got = [r.n for r in checks.infer_exact_bullets(df).orderBy("i").collect()]
    assert got == [99999999999, 99999999999, 2, (1 << 63) - 1]
    assert judged(spark, [("exact_bullets", 99999999999, None, None)], "- a").pass_all is False
    assert judged(spark, [("first_n_lines_questions", 99999999999, None, None)], "a?").results[0].reason == "too_few_lines"


def test_repeated_answers_all_count(spark):
    df = spark.createDataFrame(
        [
            ("p", "base", "det", [("exact_bullets", 1, None, None)], "- a"),
            ("p", "base", "det", [("exact_bullets", 1, None, None)], "- a\n- b"),
            ("p", "sft", "det", [("exact_bullets", 1, None, None)], "x"),
        ],
        f"id string, model string, variant string, checks {schemas.CHECKS}, cleaned string",
    )
    done = checks.judge(df)
    got = {(r.metric, r.model, r.check_type): (r.num, r.den) for r in summary.eval_summary(done).collect()}
    assert got == {
        ("pass_all_rate", "base", None): (1, 2),
        ("pass_all_rate", "sft", None): (0, 1),
        ("pass_all_rate", "dpo", None): (0, 0),
        ("per_check_rate", "base", "exact_bullets"): (1, 2),
        ("per_check_rate", "sft", "exact_bullets"): (0, 1),
        ("wins", "base", None): (1, None),
        ("ties", None, None): (0, None),
    }
    rates = {r.model: (r.passed, r.applicable) for r in summary.pass_all_rate(checks.verdicts(done)).collect()}
    assert rates["base"] == (1, 2)


def test_json_is_not_judged_by_its_size(spark):
    check = [("json_schema", None, None, ("object", ["k"], None))]
    for number in ("7" * 1200, "0." + "7" * 1200, "-1" + "0" * 1200 + "e5"):
        assert judged(spark, check, '{"k": ' + number + "}").pass_all is True
    assert judged(spark, check, '{"k": 0' + "7" * 1200 + "}").results[0].reason == "json_parse_error"
    r = judged(spark, check, '{"k": "' + "x" * 21_000_000 + '"}')
    assert (r.results[0].reason, r.pass_all) in (("json_too_large", None), (None, True))


def test_cut_prompts_tie(spark):
    df = spark.createDataFrame([(0, 5), (1, 2000), (2, 1024), (3, 1500), (4, 1023)], "ord bigint, n_tokens bigint")
    got = ordering.length_sorted_order(df, max_length=1024).orderBy("rank").collect()
    assert [(r.ord, r.n_tokens) for r in got] == [(1, 1024), (2, 1024), (3, 1024), (4, 1023), (0, 5)]
    batches = ordering.length_sorted_batches(df, batch_size=2, max_length=1024)
    assert {r.padded_len for r in batches.collect()} == {1024, 8}


def test_a_prompts_own_schema_is_read_and_used(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"id": "a", "prompt": "Return only valid JSON.", "json_schema": {"type": "object", "required": ["k"]}}\n'
        '{"id": "b", "prompt": "Return only valid JSON."}\n'
    )
    items = readers.src_prompt_items(spark, str(tmp_path / "p.json"), multiline=False)
    got = {r.id: r.checks[0] for r in checks.infer_checks(items).collect()}
    assert (got["a"].schema.type, got["a"].schema.required) == ("object", ["k"]) and got["b"].schema is None


def test_summary_aggregates_by_hash(spark):
    df = spark.createDataFrame([], f"id string, model string, variant string, checks {schemas.CHECKS}, cleaned string")
    plan = summary.eval_summary(checks.judge(df.withColumn("id", F.col("id"))))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
