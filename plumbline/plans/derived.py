"""Derived tables: preference pairs, prompts, answers and token scores.

The given texts hold nothing that the checks look for, so answers with junk,
bullets, questions and JSON are derived from them. ``oracle_sql`` states the
same tables for DuckDB. Joins are on unique keys and nothing is collected, so
the derivation scales with the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline import schemas, settings
from plumbline.functions.hashing import hash32
from plumbline.functions.text import words
from plumbline.operators.preference import word_tokens
from plumbline.settings import MODELS, VARIANTS


TABLES = {
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return settings.ensure(spark).read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


def _lit(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _case(selector: str, values, default: str = "''") -> str:
    """SQL text: one of the given expressions by number."""
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {selector} {arms} ELSE {default} END"


def _texts(selector: str, texts) -> str:
    return _case(selector, [_lit(t) for t in texts])


def pref_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the reply after it and a reply of the next conversation."""
    conv = read(spark, sf_dir, "conversations")
    replies = conv.where(F.col("role") == "assistant")
    user = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    chosen = replies.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("chosen"))
    other = replies.select(
        (F.col("conv_id") - 1).alias("conv_id"),
        (F.col("turn") - 1).alias("turn"),
        F.col("text").alias("other"),
    )
    h = F.col("h")
    half = F.substring("chosen", F.lit(1), F.floor(F.char_length("chosen") / 2).cast("int"))
    return (
        user.join(chosen, ["conv_id", "turn"])
        .join(other, ["conv_id", "turn"], "left")
        .withColumn("pair_id", F.concat_ws("-", "conv_id", "turn"))
        .withColumn("h", hash32(F.col("pair_id")))
        .select(
            "pair_id",
            (F.col("conv_id") * 1048576 + F.col("turn")).alias("ord"),
            F.when(h % 10 == 0, "test").otherwise("train").alias("split"),
            "prompt",
            "chosen",
            F.when(h % 11 == 0, F.col("chosen"))
            .otherwise(F.coalesce("other", half))
            .alias("rejected"),
            "h",
        )
    )


def _padded(text: str, h: Column) -> Column:
    t = F.col(text)
    return (
        F.when(h % 5 == 0, F.concat(F.lit("\xa0"), t, F.lit("\n　")))
        .when(h % 5 == 1, F.concat(F.lit("\x1c "), t, F.lit("\x85 ")))
        .otherwise(t)
    )


def _message(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("content"))


def pref_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs as message lists, with outer white space on some texts."""
    h = F.col("h")
    padded = pref_pairs(spark, sf_dir).select(
        "pair_id",
        "ord",
        "split",
        "h",
        _padded("prompt", h).alias("prompt"),
        _padded("chosen", h).alias("chosen"),
        _padded("rejected", h).alias("rejected"),
    )
    prompt = F.col("prompt")
    asked = _message("user", prompt)
    return padded.select(
        "pair_id",
        "ord",
        "split",
        "prompt",
        F.when(h % 7 == 0, F.array(_message("system", prompt)))
        .when(h % 3 == 0, F.array(_message("system", F.lit("Be brief.")), asked))
        .when(h % 3 == 1, F.array(asked, _message("assistant", F.col("chosen"))))
        .otherwise(F.array(asked))
        .alias("messages"),
        F.array(asked, _message("assistant", F.col("chosen"))).alias("chosen"),
        F.array(asked, _message("assistant", F.col("rejected"))).alias("rejected"),
    )


# Wording of the rule by kind of prompt
RULES = (
    "Summarise the text below in exactly 3 bullets.",
    "Answer in 2 bullets. The FIRST 1 question comes before them.",
    "Ask me 2 questions about the text below.",
    'Return only valid JSON like {"intent": "...", "urgency": "low"} '
    'where urgency: "low"|"medium"|"high".',
    'Return only valid JSON: {"intent": "...", "topic": "...", "intent": "..."} with '
    'level: "a"|"b", intent: "ask"|"tell" and later intent: "ask" | "say".',
    "Describe the text below.",
)

TICKET = {
    "type": "object",
    "required": ["intent", "urgency"],
    "enums": {"urgency": ["low", "medium", "high"]},
}


def _check(kind: str, n: str = "null", prefix: str = "null", schema: str = "null") -> Column:
    return F.expr(
        f"named_struct('type', '{kind}', 'n', {n}, 'prefix', cast({prefix} AS string), "
        f"'schema', cast({schema} AS {schemas.CHECK_SCHEMA}))"
    )


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prompt per document: a rule in words, the whole text, declared checks."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    ticket = (
        "named_struct('type', 'object', 'required', array('intent', 'urgency'), "
        "'enums', map('urgency', array('low', 'medium', 'high')))"
    )
    declared = [
        F.array(_check("exact_bullets", "3", "'- '")),
        F.array(_check("exact_bullets", "2"), _check("first_n_lines_questions", "1")),
        F.array(_check("first_n_lines_questions", "2")),
        F.array(_check("json_schema", schema=ticket)),
        F.array(_check("max_words", "50"), _check("json_schema")),
    ]
    k = F.col("k")
    checks = F.when(k == 0, declared[0])
    for i, listed in enumerate(declared[1:], 1):
        checks = checks.when(k == i, listed)
    # The last kind declares nothing: half of it no list, half an empty one
    checks = checks.when(F.expr("(ord div 6) % 2 != 0"), F.array()).cast(schemas.CHECKS)
    return (
        docs.join(labels, "doc_id", "left")
        .selectExpr(
            "concat('p', doc_id) AS id",
            "doc_id AS ord",
            "doc_id % 6 AS k",
            "CASE WHEN toxic = 1 THEN 'safety_harm' WHEN toxic IS NOT NULL THEN 'general' END AS category",
            f"concat({_texts('doc_id % 6', RULES)}, '\n\n', text) AS prompt",
            "text",
        )
        .withColumn("checks", checks)
    )


JUNK = (
    "",
    "\ufeff",
    "\ufffd\ufffd ",
    "Assistant: ",
    "\U0001f310 assistant :",
    " EM2. ",
    "limelight: im_assistant: ",
    "\"`' ",
    "\u3000ASSISTANT:\ufeff ",
)

# Bodies by kind, eight of each
BULLET_BODIES = (
    "- a\n- b\n- c",
    "- a\n- b\n- c\n- d",
    "1. a\n2) b\n3. c",
    "a) x\nB. y\nc) z",
    "- a\n- \n- b\n-",
    "- a\n\n  - b\n \n\t- c",
    "- a\r\n- b\r\n- c\r\n",
    "• a\n* b\n- c",
)
MIXED_BODIES = (
    "Ready?\n- a\n- b",
    "Ready.\n* a\n• b",
    "Ready?\n1. a\n2) b",
    "Ready?\na. x\nb) y\nc) z",
    "Ready?\n- \n- b",
    "\n\nReady?\n\n- a\n\n- b",
    "Ready?\r\n- a\r\n- b",
    "Ready?",
)
QUESTION_BODIES = (
    "Who?\nWhy?",
    "Who?\nBecause.",
    "Who?",
    "Who？\nWhy?",
    "\n \nWho? ok\n\nWhy?",
    "1. Who?\n2. Why?",
    "Who?\rWhy?\r",
    "",
)
TICKET_BODIES = (
    '{"intent": "ask", "urgency": "low"}',
    '{"intent": "ask"}',
    '{"intent": "ask", "urgency": "now"}',
    '{"intent": null, "urgency": 3}',
    'Here: {"intent": "ask", "urgency": "low"} and {"x": 1}.',
    "{'intent': 'ask', 'urgency': 'low'}",
    "[1, 2]",
    '{"intent": "a", "urgency": "now", "urgency": "high"}',
)
TOPIC_BODIES = (
    '{"intent": "ask", "topic": "x"}',
    '{"topic": "x"}',
    '{"intent": "tell", "topic": "x"}',
    '{"intent": "say", "topic": "x", "level": "c"}',
    '"text"',
    "A:\n```json\n7\n```",
    "A: ```\n```",
    '{"intent": ["ask"], "topic": {"a": null}}',
)


def generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer per prompt, model and variant; every 17th or so is missing."""
    v, dress = "(shiftright(h, 10) % 8)", "(shiftright(h, 15) % 4)"
    ticket = _texts(v, TICKET_BODIES)
    bodies = [
        f"concat({_texts(v, BULLET_BODIES)}, '\n\n', text)",
        f"concat({_texts(v, MIXED_BODIES)}, if({v} = 7, '', concat('\n', text)))",
        f"concat({_texts(v, QUESTION_BODIES)}, if({v} IN (2, 7), '', concat('\n', text)))",
        _case(
            dress,
            [ticket, f"concat(text, '\n```json\n', {ticket}, '\n```')", f"concat(text, '\n', {ticket})"],
            f"concat('```JSON\n', {ticket}, '\n```\nDone. ```x```')",
        ),
        f"concat(if({v} < 5, concat(text, '\n'), ''), {_texts(v, TOPIC_BODIES)})",
    ]
    junk = _texts("(shiftright(h, 5) % 9)", JUNK)
    return (
        prompts(spark, sf_dir)
        .select("id", "ord", "k", "text")
        .withColumn("model", F.explode(F.array(*map(F.lit, MODELS))))
        .withColumn("variant", F.explode(F.array(*map(F.lit, VARIANTS))))
        .withColumn("h", hash32(F.concat("id", "model", "variant")))
        .selectExpr(
            "id",
            "ord",
            "model",
            "variant",
            f"CASE WHEN h % 17 != 0 THEN concat({junk}, {_case('k', bodies, 'text')}) END AS raw",
        )
    )


def token_logprobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in token scores: whole numbers (thousandths of a nat) from a hash."""
    pairs = pref_pairs(spark, sf_dir)
    sides = pairs.select(
        "pair_id",
        "prompt",
        F.size(words(F.col("prompt"))).cast("bigint").alias("n_prompt"),
        F.explode(
            F.create_map(F.lit("chosen"), F.col("chosen"), F.lit("rejected"), F.col("rejected"))
        ).alias("side", "completion"),
    ).withColumn("text", F.concat_ws("\n", "prompt", "completion"))
    tokens = word_tokens(sides, ["pair_id", "side", "n_prompt"])
    return tokens.withColumn("model", F.explode(F.array(*map(F.lit, MODELS)))).select(
        "pair_id",
        "model",
        "side",
        "pos",
        (F.col("pos") < F.col("n_prompt")).alias("is_prompt"),
        (-(hash32(F.concat_ws("|", "token", "prev", "model")) % 5000)).alias("logp"),
    )


def prompt_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every prompt."""
    return prompts(spark, sf_dir).select(
        "id", "ord", F.size(words(F.col("prompt"))).cast("bigint").alias("n_tokens")
    )
