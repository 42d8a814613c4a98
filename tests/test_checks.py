"""Checks, verdicts and their roll-up on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.operators import checks, filters, quality, shaping, summary
from plumbline.plans import format_eval

ANSWER = f"id string, model string, variant string, prompt string, cleaned string, checks {schemas.CHECKS}"


def check(kind, n=None, prefix=None, schema=None):
    return (kind, n, prefix, schema)


def results(spark, cleaned, listed, prompt="", infer=False):
    df = spark.createDataFrame([("p", "base", "det", prompt, cleaned, listed)], ANSWER)
    row = checks.evaluate(df, infer).first()
    return row.pass_all, row.results


def one(spark, cleaned, c, prompt=""):
    return results(spark, cleaned, [c], prompt)[1][0]


def test_bullet_check(spark):
    r = one(spark, "- a\n- b", check("exact_bullets", 2, "- "))
    assert (r["pass"], r.found_count, r.expected, r.prefix, r.reason) == (True, 2, "2", "- ", None)
    assert one(spark, "1. a\n- b", check("exact_bullets", 2, "- ")).found_count == 1
    # An empty prefix is no prefix; a bare marker is no bullet
    assert one(spark, "1. a\n- \n* b", check("exact_bullets", 2, "")).found_count == 2


def test_question_check(spark):
    c = check("first_n_lines_questions", 2)
    assert one(spark, "Who?\n\nWhy?\nx", c)["pass"] is True
    few = one(spark, "Who?", c)
    assert (few["pass"], few.reason, few.found_count, few.expected) == (False, "too_few_lines", 1, "2")
    assert one(spark, "Who?\nx", c).checked_lines == ["Who?", "x"]
    assert one(spark, "Who？\nWhy?", c)["pass"] is False
    assert one(spark, "", check("first_n_lines_questions", 0))["pass"] is True


TICKET = ("object", ["intent", "urgency"], {"urgency": ["low", "high"]})


def test_json_check_order(spark):
    c = check("json_schema", schema=TICKET)
    reason = lambda text: one(spark, text, c).reason
    assert reason("nothing here") == "no_json_found"
    assert reason("``` ```") == "no_json_found"
    assert reason('{"a":1} x {"b":2}') == "json_parse_error"
    assert reason("[1, 2]") == "wrong_type"
    assert one(spark, "[1, 2]", c).found_type == "list"
    missing = one(spark, '{"urgency":"no"}', c)
    assert (missing.reason, missing.missing) == ("missing_keys", ["intent"])
    broken = one(spark, '{"intent":1,"urgency":"no"}', c)
    assert broken.reason == "enum_violation"
    assert broken.details["urgency"].found == "no"
    assert broken.details["urgency"].allowed == ["low", "high"]
    good = one(spark, '{"intent":null,"urgency":3}', c)
    assert good["pass"] and good.required_checked == ["intent", "urgency"]
    assert one(spark, '{"intent":1,"urgency":"no","urgency":"low"}', c)["pass"]


def test_json_check_falls_back_to_prompt(spark):
    prompt = '{"a": 1} level: "x"|"y"'
    empty = check("json_schema", schema=(None, [], {}))
    assert one(spark, '{"b":1}', empty, prompt).missing == ["a"]
    assert one(spark, '{"a":1,"level":"z"}', empty, prompt).reason == "enum_violation"
    # Other values than objects have no members to miss
    assert one(spark, "[]", check("json_schema"), prompt)["pass"]


def test_unknown_check_and_no_checks(spark):
    verdict, (r,) = results(spark, "x", [check("max_words", 3)])
    assert verdict is False and r.reason == "unknown_check:max_words"
    assert results(spark, "x", [])[0] is None
    assert results(spark, "x", None)[0] is None


def test_inferred_policy(spark):
    prompt = "exactly 1 bullet, ask 1 question, return only valid JSON"
    _, rs = results(spark, "- a?", None, prompt, infer=True)
    assert [r.type for r in rs] == ["exact_bullets", "first_n_lines_questions", "json_schema"]
    assert results(spark, "- a", [], prompt, infer=True)[1] == []
    # The older policy has no bullet prefix
    _, (r,) = results(spark, "1. a", [check("exact_bullets", 1, "- ")], prompt, infer=True)
    assert r["pass"] and r.prefix is None


def verdicts(spark, rows):
    return spark.createDataFrame(rows, "id string, model string, pass_all boolean, n_passed bigint")


def outcome(df):
    return {r.outcome: r.n for r in df.collect()}


def test_wins_and_ties(spark):
    v = verdicts(
        spark,
        [
            ("1", "base", True, 2), ("1", "sft", False, 1),
            ("2", "base", None, 0), ("2", "sft", None, 0),
            ("3", "dpo", False, 0),
            ("4", "base", True, 1), ("4", "sft", True, 1), ("4", "dpo", False, 0),
        ],
    )
    assert outcome(summary.wins_and_ties(v)) == {"base": 1, "dpo": 1, "tie": 2}
    assert outcome(summary.wins_and_ties(v, skip_unchecked=True)) == {"base": 1, "dpo": 1, "tie": 1}
    assert outcome(summary.wins_and_ties(v.limit(0))) == {"tie": 0}
    rates = {r.model: (r.passed, r.applicable, r.rate) for r in summary.pass_all_rate(v).collect()}
    assert rates == {"base": (2, 2, 1.0), "sft": (1, 2, 0.5), "dpo": (0, 2, 0.0)}


def test_pass_rate_without_applicable_is_null(spark):
    v = verdicts(spark, [("1", "base", None, 0)])
    assert {r.rate for r in summary.pass_all_rate(v).collect()} == {None}


def test_summary_agrees_with_its_parts(spark):
    rows = [
        (f"p{i}", m, v, "", text, [check("exact_bullets", 1), check("first_n_lines_questions", 1)] if i % 3 else [])
        for i in range(12)
        for j, m in enumerate(("base", "sft", "dpo"))
        for v in ("det", "samp")
        for text in [("- a", "- a?", "a?", "")[(i + j) % 4]]
    ]
    done = checks.evaluate(spark.createDataFrame(rows, ANSWER))
    det = filters.select_variant(done)
    got = {(r.metric, r.model, r.check_type): (r.num, r.den) for r in summary.eval_summary(done).collect()}
    for r in summary.pass_all_rate(checks.verdicts(det)).collect():
        assert got.pop(("pass_all_rate", r.model, None)) == (r.passed, r.applicable)
    for r in summary.per_check_rate(checks.check_results(det)).collect():
        assert got.pop(("per_check_rate", r.model, r.check_type)) == (r.passed, r.total)
    wins = outcome(summary.wins_and_ties(checks.verdicts(det)))
    assert got.pop(("ties", None, None))[0] == wins.pop("tie")
    assert {m: n for (_, m, _), (n, _) in got.items()} == wins


def test_missing_category_is_kept(spark):
    df = spark.createDataFrame([("a", None), ("b", "safety_harm"), ("c", "x")], "id string, category string")
    kept = lambda **kw: {r.id for r in filters.skip_categories(df, **kw).collect()}
    assert kept() == {"a", "c"}
    assert kept(categories=[]) == {"a", "b", "c"}


def test_flow_without_cleaning(spark):
    prompts = spark.createDataFrame(
        [("p", "x", "", [check("exact_bullets", 1)])], f"id string, category string, prompt string, checks {schemas.CHECKS}"
    )
    answers = spark.createDataFrame(
        [("p", "base", "det", '"- a"'), ("p", "sft", "det", None)], schemas.GENERATION
    )
    passed = lambda **kw: [r.pass_all for r in format_eval.evaluated_answers(prompts, answers, **kw).collect()]
    assert passed() == [True]
    assert passed(clean=False) == [False]


def test_last_message(spark):
    df = spark.createDataFrame(
        [
            ([("user", "q"), ("assistant", "\xa0a\x1c")],),
            ([],),
            ([("assistant", None)],),
        ],
        f"chosen {schemas.MESSAGES}",
    )
    assert [r.text for r in shaping.last_message_text(df).collect()] == ["a", None, None]
    pairs = df.select(F.lit("p").alias("prompt"), F.col("chosen").alias("response"))
    rejects = {
        r.field: r.rejects
        for r in shaping.incomplete_rows(shaping.build_sft_pairs(df.withColumn("prompt", F.lit("p")))).collect()
    }
    assert rejects == {"prompt": 0, "response": 2}
    assert pairs.count() == 3


def test_string_list_and_variant_fields_agree(spark):
    lists = spark.createDataFrame([([("user", "q"), ("assistant", " a ")],)], f"chosen {schemas.MESSAGES}")
    as_variant = lists.select(F.parse_json(F.to_json("chosen")).alias("chosen"))
    plain = spark.sql("""SELECT parse_json('" a "') AS chosen""")
    text = lambda d: shaping.last_message_text(d).first().text
    assert text(lists) == text(as_variant) == text(plain) == "a"
    assert shaping.last_user_message(as_variant, "chosen").first().prompt == "q"


def test_second_layout_and_unknown_layout(spark):
    df = spark.createDataFrame(
        [([("system", "s"), ("user", "q"), ("assistant", "x")], "c ", " r")],
        f"messages {schemas.MESSAGES}, chosen string, rejected string",
    )
    assert tuple(shaping.normalize_preference_schema(df).first()) == ("q", "c", "r")
    with pytest.raises(KeyError):
        shaping.normalize_preference_schema(df.drop("chosen"))


def test_required_keys(spark):
    rows = [(0, '{"a":1,"b":null}'), (1, '{"a":2}'), (2, "[]"), (3, '{"b":1,"a":0}')]
    df = spark.createDataFrame(rows, "row bigint, value string")
    got = {r.key: (r.missing, r.first_row) for r in quality.validate_required_keys(df, ["a", "b"]).collect()}
    assert got == {"a": (1, 2), "b": (2, 1)}
    first = {r.key: r.missing for r in quality.validate_required_keys(df, ["a", "b"], limit=2).collect()}
    assert first == {"a": 0, "b": 1}
    with pytest.raises(AssertionError, match="Missing key 'b' in row 1"):
        quality.assert_required_keys(df, ["a", "b"])
    quality.assert_required_keys(df, ["a"], limit=2)
    typed = {r.key: r.missing for r in quality.validate_required_keys(df, ["row", "x"], value=None).collect()}
    assert typed == {"row": 0, "x": 4}
