"""Log-likelihood, accuracy and published arithmetic."""

import math

import pytest

from plumbline.operators import joins, preference

TOKENS = "pair_id string, model string, side string, pos bigint, is_prompt boolean, logp double"


def tokens(spark, prompt, completion, side="chosen"):
    n = len(prompt) + len(completion)
    rows = [("p", "base", side, i, i < len(prompt), float(10**i)) for i in range(n)]
    return spark.createDataFrame(rows, TOKENS)


def loglik(df, **kw):
    return preference.completion_loglik(df, **kw).first().logp


def test_positions(spark):
    # completion positions 2..4
    assert loglik(tokens(spark, "ab", "cde"), max_prompt=4, max_completion=4) == 11100
    # both budgets together cut the whole text
    assert loglik(tokens(spark, "ab", "cde"), max_prompt=2, max_completion=1) == 100
    # a short prompt lends its room
    assert loglik(tokens(spark, "a", "cdef"), max_prompt=3, max_completion=1) == 1110
    # the tail of a long prompt counts as completion
    assert loglik(tokens(spark, "abcd", "e"), max_prompt=2, max_completion=2) == 1100
    # the first token has no prediction
    assert loglik(tokens(spark, "", "ab"), max_prompt=2, max_completion=2) == 10
    # an empty completion scores nothing and stays
    assert loglik(tokens(spark, "ab", ""), max_prompt=2, max_completion=2) == 0


def test_pairs_without_tokens_stay(spark):
    pairs = spark.createDataFrame([("p", "base", "chosen"), ("q", "base", "chosen")], "pair_id string, model string, side string")
    got = {r.pair_id: r.logp for r in preference.completion_loglik(tokens(spark, "a", "b"), pairs=pairs).collect()}
    assert got == {"p": 10.0, "q": 0.0}


def margins(spark, values):
    return spark.createDataFrame([("base", float(v)) for v in values], "model string, margin double")


def test_accuracy(spark):
    r = preference.preference_accuracy(margins(spark, [1, -1, 0, 5e-7])).first()
    assert (r.n, r.preference_accuracy, r.ties) == (4, 0.5, 2)
    empty = preference.preference_accuracy(margins(spark, [1]), models=("base", "dpo")).orderBy("model").collect()
    assert [(r.model, r.n, r.preference_accuracy, r.avg_logp_margin, r.ties) for r in empty] == [
        ("base", 1, 1.0, 1.0, 0),
        ("dpo", 0, 0.0, 0.0, 0),
    ]


def test_swapped_sides_negate_the_margin(spark):
    rows = [("p", "base", "chosen", -3.0), ("p", "base", "rejected", -5.0), ("q", "base", "rejected", -1.0)]
    schema = "pair_id string, model string, side string, logp double"
    swap = {"chosen": "rejected", "rejected": "chosen"}
    plain = spark.createDataFrame(rows, schema)
    swapped = spark.createDataFrame([(p, m, swap[s], x) for p, m, s, x in rows], schema)
    value = lambda d: {r.pair_id: r.margin for r in joins.join_chosen_rejected(d).collect()}
    assert value(plain) == {"p": 2.0, "q": None}
    assert value(swapped) == {"p": -2.0, "q": None}


def test_unknown_margins_are_not_won(spark):
    r = preference.preference_accuracy(margins(spark, [float("nan"), -1])).first()
    assert (r.n, r.preference_accuracy, r.ties) == (2, 0.0, 0) and math.isnan(r.avg_logp_margin)
    rows = spark.createDataFrame([("base", 2.0), ("base", None)], "model string, margin double")
    r = preference.preference_accuracy(rows).first()
    assert (r.n, r.preference_accuracy, r.avg_logp_margin) == (2, 0.5, 2.0)


# Published: accuracy, ties → accuracy without ties, accuracy with ties as half
PUBLISHED = [
    (0.2705, 723, 0.4236, 0.4512), (0.2580, 723, 0.4041, 0.4387), (0.2715, 723, 0.4252, 0.4522),
    (0.2625, 756, 0.4220, 0.4515), (0.2545, 756, 0.4092, 0.4435), (0.2670, 756, 0.4293, 0.4560),
]


def test_published_arithmetic(spark):
    rows = [(i, 2000, a, t) for i, (a, t, _, _) in enumerate(PUBLISHED)]
    metrics = spark.createDataFrame(rows, "i int, n bigint, preference_accuracy double, ties bigint")
    for r in preference.tie_aware_accuracy(metrics).collect():
        _, _, without, half = PUBLISHED[r.i]
        assert r.accuracy_excl_ties == pytest.approx(without, abs=5.1e-5)
        assert r.accuracy_w_ties_half == pytest.approx(half, abs=5.1e-5)


def test_reference_margin(spark):
    schema = "pair_id string, logp_chosen double, logp_rejected double"
    policy = spark.createDataFrame([("p", -1.0, -3.0), ("q", -2000.0, 0.0)], schema)
    reference = spark.createDataFrame([("p", -2.0, -2.5), ("q", 0.0, -2000.0)], schema)
    got = {r.pair_id: (r.margin, r.loss) for r in preference.preference_margin_vs_reference(policy, reference, 1.0).collect()}
    assert got["p"] == pytest.approx((1.5, math.log(1 + math.exp(-1.5))))
    assert got["q"] == pytest.approx((-4000.0, 4000.0))


def test_ngram_of_nothing(spark):
    texts = spark.createDataFrame([(1, "a b")], "k int, text string")
    tokens = preference.word_tokens(texts, ["k"])
    for order in (1, 2):
        assert [r.logp for r in preference.ngram_token_logp(tokens, tokens.limit(0), order).collect()] == [None, None]


@pytest.mark.parametrize("order", [1, 2])
def test_ngram(spark, order):
    texts = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "")], "k int, text string")
    corpus = preference.word_tokens(texts.where("k < 3"), ["k"])
    scored = preference.ngram_token_logp(preference.word_tokens(texts, ["k"]), corpus, order)
    got = {(r.k, r.pos): math.exp(r.logp) for r in scored.collect()}
    if order == 1:
        want = {(1, 0): 3 / 8, (1, 1): 3 / 8, (1, 2): 3 / 8, (2, 0): 3 / 8, (2, 1): 2 / 8}
    else:
        want = {(1, 0): 2 / 5, (1, 1): 2 / 4, (1, 2): 2 / 5, (2, 0): 2 / 5, (2, 1): 2 / 5}
    assert got == pytest.approx(want)
