"""Strict JSON of any size: the recogniser against Python's json.loads, and checks on long values."""

import json
import random

from pyspark.sql import functions as F

from plumbline.functions import jsontext
from test_edge_cases import judged
from test_text import column


def parses(s):
    try:
        json.loads(s)
        return True
    except (ValueError, RecursionError):
        return False


def mutated(n, seed):
    """Valid JSON texts with random insertions, deletions and swaps of JSON-ish characters."""
    rnd = random.Random(seed)
    pieces = list('{}[]:,"\\ \t\n\r0123456789-+.eEtrufalsnNIyx\x01é') + ["true", "null", "NaN", "Infinity", "\\u00e9", "\\ud800"]

    def value(depth):
        r = rnd.random()
        if depth > 3 or r < 0.3:
            return rnd.choice([0, -1.5e-3, 10**rnd.randrange(40), "s\"\\\n", "é", True, None, float("nan")])
        if r < 0.65:
            return [value(depth + 1) for _ in range(rnd.randrange(4))]
        return {rnd.choice("abk"): value(depth + 1) for _ in range(rnd.randrange(4))}

    out = []
    for _ in range(n):
        s = json.dumps(value(0), indent=rnd.choice([None, 1]))
        for _ in range(rnd.randrange(3)):
            i = rnd.randrange(len(s) + 1)
            op = rnd.random()
            if op < 0.4:
                s = s[:i] + rnd.choice(pieces) + s[i:]
            elif op < 0.8:
                s = s[:i] + s[i + 1 :]
            else:
                s = s[:i] + s[i + 1 : i + 2] + s[i : i + 1] + s[i + 2 :]
        out.append(s)
    return out


def test_recogniser_agrees_with_python_on_mutated_json(spark):
    texts = mutated(3000, 11)
    got = column(spark, texts, lambda t: F.coalesce(jsontext.recognised(t), F.lit(False)))
    want = [parses(s) for s in texts]
    wrong = [(s, g) for s, g, w in zip(texts, got, want) if g != w]
    assert wrong == []
    assert 0.2 < sum(want) / len(want) < 0.9


def test_values_of_any_length_are_judged_whole(spark):
    big = "7" * 2000
    texts = [
        '{"a": "' + big + '"}', '{"' + big + '": 1}', '{"a": ' + big + "}", '{"a": -' + big + ".5e-" + big + "}",
        '{"a": 0' + big + "}", '{"a": "' + "x" * 20_000_000 + '"}', "[" * 900 + "]" * 900,
    ]
    got = column(spark, texts, lambda t: F.isnotnull(jsontext.strict_value(t)))
    assert got == [True, True, True, True, False, True, True]
    check = lambda enums: [("json_schema", None, None, ("object", ["k"], enums))]
    d300, d301 = "1" * 300, "1" * 301
    # Equal long strings pass; a string one digit longer than the allowed one breaks it.
    assert judged(spark, check({"k": [d301]}), '{"k": "' + d301 + '"}').pass_all is True
    r = judged(spark, check({"k": [d300]}), '{"k": "' + d301 + '"}')
    assert (r.pass_all, r.results[0].reason) == (False, "enum_violation")
    # A key of 301 digits is that key, not a shortened one.
    r = judged(spark, [("json_schema", None, None, ("object", [d301], None))], '{"' + d300 + '": 1}')
    assert (r.pass_all, r.results[0].reason) == (False, "missing_keys")
    assert judged(spark, [("json_schema", None, None, ("object", [d301], None))], '{"' + d301 + '": 1}').pass_all is True
    # A number of 2,000 digits is a number, not a string, for the enum check.
    assert judged(spark, check({"k": ["low"]}), '{"k": ' + big + "}").pass_all is True
    assert judged(spark, check({"k": ["low"]}), '{"k": NaN, "j": "' + big + '"}').pass_all is True
    # Repeated keys: the last one counts, as in a Python dict.
    assert judged(spark, check({"k": ["low"]}), '{"k": "high", "k": "low"}').pass_all is True
    assert judged(spark, check({"k": ["low"]}), '{"k": "low", "k": "high"}').pass_all is False
