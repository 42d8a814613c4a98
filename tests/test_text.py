"""Column expressions against plain Python on edge cases and random texts."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import bullets, cleaning, inference, jsontext
from plumbline.functions.text import WS, WS_CHARS, lines, strip, words


def column(spark, texts, expr):
    """Values of an expression over the texts, in their order."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.v for r in df.select("i", expr(F.col("t")).alias("v")).orderBy("i").collect()]


def random_texts(pieces, n, seed, longest=8):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(longest))) for _ in range(n)]


def test_white_space_is_pythons(spark):
    white = {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert set(WS_CHARS) == white
    points = [chr(c) for c in range(1, 0x3100)]
    hits = column(spark, points, lambda t: t.rlike(rf"\A{WS}\z"))
    assert {p for p, hit in zip(points, hits) if hit} == white


def test_strip_lines_words(spark):
    pieces = list("\xa0　\x1c​﻿\n\r\x85  ") + ["a", "bc", "- "]
    texts = random_texts(pieces, 400, 1)
    assert column(spark, texts, strip) == [t.strip() for t in texts]
    assert column(spark, texts, words) == [t.split() for t in texts]
    stripped = [[s for s in map(str.strip, t.split("\n")) if s] for t in texts]
    assert column(spark, texts, lines) == stripped


SPEAKERS = ("assistant", "im_assistant", "limelight")


def expected_clean(text):
    """Peel junk off the front piece by piece."""
    rest = (text or "").strip()

    def peel(s):
        s = s.lstrip()
        if s[:1] in ("﻿", "�"):
            return s[1:]
        low = s.lower()
        if low.startswith("em"):
            digits = len(s[2:]) - len(s[2:].lstrip("0123456789"))
            if digits and s[2 + digits : 3 + digits] == ".":
                return s[3 + digits :]
        globe = s[1:].lstrip() if s.startswith("\U0001f310") else None
        for speaker in SPEAKERS:
            for body in [s] + ([globe] if globe is not None and speaker == "assistant" else []):
                after = body[len(speaker) :].lstrip()
                if body.lower().startswith(speaker) and after.startswith(":"):
                    return after[1:]
        return s

    while (peeled := peel(rest)) != rest:
        rest = peeled
    rest = rest.lstrip("`\"' \n\t")
    return rest.replace("\r\n", "\n").replace("\r", "\n").strip()


def test_cleaning(spark):
    pieces = [
        "﻿", "�", "\U0001f310", "Assistant", "assistant:", " ", "\n", "\xa0", ":", "im_",
        "im_assistant :", "LIMELIGHT:", "EM2.", "em", "33", ".", "`", '"', "'", "\r\n", "\r", "x", "Hello",
    ]
    texts = random_texts(pieces, 3000, 2) + ["", "no junk: here", None]
    assert column(spark, texts, cleaning.clean) == [expected_clean(t) for t in texts]


def test_cleaning_folds_unicode_case(spark):
    texts = ["aſſistant: x", "lımelight: x", "EM٣. x"]
    assert column(spark, texts, cleaning.clean) == ["x", "x", "x"]


def test_cleaning_survives_long_junk(spark):
    texts = ["� " * 50_000 + "Assistant: " * 20_000 + "x", "a" + " " * 200_000 + "b"]
    assert [len(t) for t in column(spark, texts, cleaning.clean)] == [1, 200_002]


def is_bullet(line):
    s = line.strip()
    digits = len(s) - len(s.lstrip("0123456789"))
    if s[:1] in "-*•" and s:
        marker = 1
    elif digits and s[digits : digits + 1] in (".", ")"):
        marker = digits + 1
    elif s[:1].isascii() and s[:1].isalpha() and s[1:2] in (".", ")"):
        marker = 2
    else:
        return False
    return s[marker : marker + 1].isspace()


LINE_PIECES = [
    "-", "*", "•", "1.", "12)", "a.", "B)", " ", "\xa0", "\t", "\n", "\n", "x", "?", "\r", "\x85", " ", "ab.",
]


def test_bullets(spark):
    texts = random_texts(LINE_PIECES, 3000, 3, 14) + ["- ", "-\n- a", "-  a\n*b"]
    got = column(spark, texts, bullets.bullet_count)
    assert got == [sum(map(is_bullet, t.split("\n"))) for t in texts]


@pytest.mark.parametrize("prefix", ["- ", "-", "1."])
def test_prefixed_bullets(spark, prefix):
    texts = random_texts(LINE_PIECES, 500, 4, 14) + ["- ", "-"]
    got = column(spark, texts, lambda t: bullets.prefixed_count(lines(t), F.lit(prefix)))
    assert got == [sum(s.strip().startswith(prefix) for s in t.split("\n")) for t in texts]


def expected_candidate(text):
    opened = text.find("```")
    closed = text.find("```", opened + 3) if opened >= 0 else -1
    if closed >= 0:
        body = text[opened + 3 : closed]
        return (body[4:] if body[:4].lower() == "json" else body).strip()
    for a, b in ("{}", "[]"):
        i, j = text.find(a), text.rfind(b)
        if 0 <= i < j:
            return text[i : j + 1]
    return None


def test_json_candidate(spark):
    pieces = ["```", "`", "json", "JSON", "{", "}", "[", "]", " ", "\n", "a", "1", "\U0001f310"]
    texts = random_texts(pieces, 3000, 5, 12) + ["} {", "``````", "```json```", "x ```\n```"]
    assert column(spark, texts, jsontext.candidate) == [expected_candidate(t) for t in texts]


def test_strict_json(spark):
    import json

    whole = [
        '{"a":1}', "[1,2]", '"s"', "null", "true", "-1.5e3", " 7 ", '{"a":{"b":[1,{"c":null}]}}', '{"a":1,"a":2}',
        '{"a":1} x', '{"a":1} {"b":2}', "1,2", "1],[2", '1} ,{"b":2', "{'a':1}", '{"a":1}}', "", "{", '["a" "b"]',
        '{"a":01}', '"a\nb"', "tru", '1,"v":2', "],[", "//x", '{"a":1,}',
    ]

    def parses(s):
        try:
            json.loads(s)
            return True
        except ValueError:
            return False

    got = column(spark, whole, lambda t: F.isnotnull(jsontext.strict_value(t)))
    assert got == [parses(s) for s in whole]
    # Python's own extension: NaN, Infinity and -Infinity are numbers.
    constants = ["NaN", "-Infinity", '{"a": Infinity}', "[NaN, 1]", "nan", "+Infinity", "-NaN", "Infinity1"]
    assert column(spark, constants, lambda t: F.isnotnull(jsontext.strict_value(t))) == [parses(s) for s in constants]


def test_type_names(spark):
    import json

    texts = ["{}", "[]", '"s"', "true", "false", "null", "1", "-20", "1.0", "1e5", "-0.5"]
    assert column(spark, texts, jsontext.type_name) == [type(json.loads(t)).__name__ for t in texts]


def test_inference(spark):
    n = column(
        spark,
        [
            "Give EXACTLY  5 bullets", "in 2 bullet points", "exactly five bullets", "éexactly 5 bullets",
            "in 3 bullets, exactly 4 bullets", "inexactly 5 bullets", "exactly 5 bulletss", "within 5 bullets", None,
        ],
        inference.bullets,
    )
    assert n == [5, 2, None, None, 4, None, None, None, None]
    n = column(
        spark,
        ["Ask me 3 questions", "ask 1 question.", "the first 2 questions", "task 3 questions", "ask me me 2 questions"],
        inference.questions,
    )
    assert n == [3, 1, 2, None, None]
    flag = column(spark, ["Return only  valid JSON", "return only valid jsonl", "Return valid JSON"], inference.wants_json)
    assert flag == [True, False, False]


def test_inferred_schema(spark):
    prompts = [
        '{"intent": "...", "urgency" : "low", "intent": 1, "9x": 2}',
        'urgency: "low"|"high" and tone:"a" | "b" | "c"',
        '"urgency": "low"|"high"',
        'a: "x"|"y", a: "z"|"w"',
        'a: "x"',
        'éa: "x"|"y"',
        'b: "x" | "y"c: "p"|"q"',
    ]
    keys = column(spark, prompts, inference.required_keys)
    assert keys[0] == ["intent", "urgency"]
    assert keys[2] == ["urgency"] and keys[1] == []
    enums = column(spark, prompts, inference.enums)
    assert enums == [
        {},
        {"urgency": ["low", "high"], "tone": ["a", "b", "c"]},
        {},
        {"a": ["z", "w"]},
        {},
        {},
        {"b": ["x", "y"], "c": ["p", "q"]},
    ]
