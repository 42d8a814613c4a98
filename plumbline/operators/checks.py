"""Format checks over cleaned answers.

Checks are evaluated inside the row that holds the answer, so the verdict on
all checks of an answer needs no regrouping and no shuffle.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import schemas, settings
from plumbline.functions import bullets, inference, jsontext
from plumbline.functions.text import lines

BULLETS = "exact_bullets"
QUESTIONS = "first_n_lines_questions"
JSON = "json_schema"


# Which checks apply

def declared_checks(df: DataFrame) -> DataFrame:
    """The declared list, or an empty one."""
    return df.withColumn(
        "checks", F.coalesce(F.col("checks"), F.array().cast(schemas.CHECKS))
    )


def _check(kind: str, n: Column | None = None, schema: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        (F.lit(None) if n is None else n).cast("bigint").alias("n"),
        F.lit(None).cast("string").alias("prefix"),
        (F.lit(None) if schema is None else schema).cast(schemas.CHECK_SCHEMA).alias("schema"),
    )


def infer_checks(df: DataFrame) -> DataFrame:
    """The declared list even if empty, else what the prompt asks for in words."""
    prompt = F.col("prompt")
    n_bullets, n_questions = inference.bullets(prompt), inference.questions(prompt)
    schema = F.col("json_schema") if "json_schema" in df.columns else None
    inferred = F.array_compact(
        F.array(
            F.when(F.isnotnull(n_bullets), _check(BULLETS, n_bullets)),
            F.when(F.isnotnull(n_questions), _check(QUESTIONS, n_questions)),
            F.when(inference.wants_json(prompt), _check(JSON, schema=schema)),
        )
    )
    return df.withColumn("checks", F.coalesce(F.col("checks"), inferred.cast(schemas.CHECKS)))


def infer_exact_bullets(df: DataFrame) -> DataFrame:
    return df.withColumn("n", inference.bullets(F.col("prompt")))


def infer_first_n_questions(df: DataFrame) -> DataFrame:
    return df.withColumn("n", inference.questions(F.col("prompt")))


def infer_json_check(df: DataFrame) -> DataFrame:
    return df.withColumn("flag", inference.wants_json(F.col("prompt")))


def infer_required_keys(df: DataFrame) -> DataFrame:
    return df.withColumn("keys", inference.required_keys(F.col("prompt")))


def infer_enums(df: DataFrame) -> DataFrame:
    settings.ensure(df.sparkSession)
    return df.withColumn("enums", inference.enums(F.col("prompt")))


# Evaluation

def _of_kind(*kinds: str) -> Column:
    return F.exists("checks", lambda c: c["type"].isin(*kinds))


def _or_inferred(declared: Column, inferred: Column) -> Column:
    """An empty declaration counts as none."""
    return F.when(F.size(declared) > 0, declared).otherwise(inferred)


def _undeclared(field: str) -> Column:
    """Whether some JSON check leaves the field to the prompt."""
    return F.exists(
        "checks",
        lambda c: (c["type"] == JSON) & (F.coalesce(F.size(c["schema"][field]), F.lit(0)) <= 0),
    )


@cache
def _completed(keep_prefix: bool) -> Column:
    def complete(check: Column) -> Column:
        schema = check["schema"]
        full = F.struct(
            schema["type"].alias("type"),
            _or_inferred(schema["required"], F.col("_required")).alias("required"),
            _or_inferred(schema["enums"], F.col("_enums")).alias("enums"),
        )
        return F.struct(
            check["type"].alias("type"),
            check["n"].alias("n"),
            (check["prefix"] if keep_prefix else F.lit(None).cast("string")).alias("prefix"),
            F.when(check["type"] == JSON, full).alias("schema"),
        )

    return F.transform("checks", complete)


def resolve_checks(df: DataFrame, infer: bool = False) -> DataFrame:
    """Make ``checks`` complete, so that judging needs the prompt text no more.

    JSON checks without required keys or allowed values take them from the
    prompt. ``infer`` follows the older policy: undeclared checks come from the
    prompt and bullet prefixes are ignored. On a prompt table this is done once
    per prompt, and only the checks travel to the answers.
    """
    settings.ensure(df.sparkSession)
    df = infer_checks(df) if infer else declared_checks(df)
    prompt = F.col("prompt")
    return (
        df.withColumns(
            {
                "_required": F.when(_undeclared("required"), inference.required_keys(prompt)),
                "_enums": F.when(_undeclared("enums"), inference.enums(prompt)),
            }
        )
        .withColumn("checks", _completed(keep_prefix=not infer))
        .drop("_required", "_enums")
    )


def _measure(check: Column) -> Column:
    """What a check looks at, measured once."""
    kind, prefix, schema = check["type"], check["prefix"], check["schema"]
    found = F.when(
        F.length(prefix) > 0, bullets.prefixed_count(F.col("_lines"), prefix)
    ).otherwise(F.col("_bullets"))
    breaches = F.transform_values(
        jsontext.enum_breaches(schema["enums"], F.col("_members")),
        lambda k, allowed: F.struct(
            jsontext.member_text(F.try_element_at(F.col("_members"), k)).alias("found"),
            allowed.alias("allowed"),
        ),
    )
    is_json = kind == JSON
    return F.struct(
        kind.alias("type"),
        check["n"].alias("n"),
        prefix.alias("prefix"),
        schema.alias("schema"),
        F.when(kind == BULLETS, found).alias("found"),
        F.when(kind == QUESTIONS, bullets.first_lines(F.col("_lines"), check["n"])).alias("head"),
        F.when(is_json, jsontext.absent_keys(schema["required"], F.col("_members"))).alias("missing"),
        F.when(is_json, breaches).alias("breaches"),
    )


def _json_reason(m: Column) -> Column:
    """Name of the first JSON rule that is broken; null when all hold."""
    return (
        F.when(F.coalesce(F.col("_candidate"), F.lit("")) == "", "no_json_found")
        .when(F.isnull("_value"), "json_parse_error")
        .when((m["schema"]["type"] == "object") & (F.col("_type") != "dict"), "wrong_type")
        .when(F.size(m["missing"]) > 0, "missing_keys")
        .when(F.cardinality(m["breaches"]) > 0, "enum_violation")
    )


def _judge(m: Column) -> Column:
    kind = m["type"]
    # A declared check that lacks its number says nothing about the answer.
    no_number = kind.isin(BULLETS, QUESTIONS) & F.isnull(m["n"])
    too_few = F.size(m["head"]) < m["n"]
    broken = _json_reason(m)
    passed = (
        F.when(kind == BULLETS, m["found"] == m["n"])
        .when(kind == QUESTIONS, ~too_few & bullets.all_questions(m["head"]))
        .when(kind == JSON, F.isnull(broken))
    )
    reason = (
        F.when(no_number, "missing_n")
        .when((kind == QUESTIONS) & too_few, "too_few_lines")
        .when(kind == JSON, broken)
        .when(~kind.isin(BULLETS, QUESTIONS), F.concat(F.lit("unknown_check:"), kind))
    )
    whole = (kind == JSON) & F.isnull(broken)
    wrong_type = (kind == JSON) & (broken == "wrong_type")
    return F.struct(
        kind.alias("type"),
        F.when(
            ~no_number,
            F.coalesce(passed, F.lit(False)),
        ).alias("pass"),
        reason.alias("reason"),
        F.when(kind == BULLETS, m["found"])
        .when((kind == QUESTIONS) & too_few, F.size(m["head"]).cast("bigint"))
        .alias("found_count"),
        F.when(wrong_type, F.col("_type")).alias("found_type"),
        F.when((kind == BULLETS) | ((kind == QUESTIONS) & too_few), m["n"].cast("string"))
        .when(wrong_type, m["schema"]["type"])
        .alias("expected"),
        F.when(kind == BULLETS, m["prefix"]).alias("prefix"),
        F.when((kind == JSON) & (broken == "json_parse_error"), "not one JSON value").alias("error"),
        F.when((kind == JSON) & (broken == "missing_keys"), m["missing"]).alias("missing"),
        F.when((kind == JSON) & (broken == "enum_violation"), m["breaches"]).alias("details"),
        F.when((kind == QUESTIONS) & ~too_few, m["head"]).alias("checked_lines"),
        F.when(whole, m["schema"]["required"]).alias("required_checked"),
        F.when(whole, m["schema"]["enums"]).alias("enums_checked"),
    ).cast(schemas.CHECK_RESULT)


@cache
def _steps() -> tuple[dict[str, Column], ...]:
    """Helper columns of ``judge``, each step on top of the one before.

    Columns do not change, so they are put together once per process.
    """
    text = F.col("cleaned")
    return (
        {
            "_lines": F.when(_of_kind(BULLETS, QUESTIONS), lines(text)),
            "_bullets": F.when(_of_kind(BULLETS), bullets.bullet_count(text)),
            "_candidate": F.when(_of_kind(JSON), jsontext.candidate(text)),
        },
        {"_tokens": F.when(_of_kind(JSON), jsontext.tokens(F.col("_candidate")))},
        {"_value": jsontext.strict_value(F.col("_candidate"), ts=F.col("_tokens"))},
        {
            "_members": jsontext.members(F.col("_value")),
            "_type": jsontext.type_name(F.col("_candidate")),
        },
        {"_measured": F.transform("checks", _measure)},
        {"results": F.transform("_measured", _judge)},
    )


@cache
def _outcome() -> Column:
    passed = lambda r: r["pass"]
    fields = F.struct(
        "results",
        F.when(F.size("checks") > 0, F.forall("results", passed)).alias("pass_all"),
        F.size(F.filter("results", passed)).cast("bigint").alias("n_passed"),
    )
    return F.inline_outer(F.array(fields))


def judge(df: DataFrame) -> DataFrame:
    """Add ``results`` (one record per check), ``pass_all`` and ``n_passed``.

    Needs ``cleaned`` and complete ``checks``. ``pass_all`` is null for an
    answer without checks. Text is taken apart only where a check of the row
    asks for it.
    """
    settings.ensure(df.sparkSession)
    judged = df
    for step in _steps():
        judged = judged.withColumns(step)
    # Unpacked by a generator: filters on the outcome stay above it. Moved below,
    # they would repeat the whole evaluation.
    return judged.select(*df.columns, _outcome())


def evaluate(df: DataFrame, infer: bool = False) -> DataFrame:
    """Resolve and judge in one go, for rows that hold prompt and answer."""
    return judge(resolve_checks(df, infer))


def verdicts(evaluated: DataFrame) -> DataFrame:
    return evaluated.select("id", "model", "variant", "pass_all", "n_passed")


def check_results(evaluated: DataFrame) -> DataFrame:
    """One row per answer and check.

    The outer form, as the inner one makes the optimizer add a filter on the
    array, which would judge every answer twice.
    """
    rows = evaluated.select("id", "model", "variant", F.inline_outer("results"))
    return rows.where(F.isnotnull("type"))


def run_checks(df: DataFrame, infer: bool = False) -> tuple[DataFrame, DataFrame]:
    """→ (one row per check, one verdict per answer)."""
    evaluated = evaluate(df, infer)
    return check_results(evaluated), verdicts(evaluated)


# Single checks

def _schema_literal(schema: dict | None) -> Column:
    if schema is None:
        return F.lit(None).cast(schemas.CHECK_SCHEMA)
    required, enums = schema.get("required"), schema.get("enums")
    pairs = [x for k, vs in (enums or {}).items() for x in (F.lit(k), F.array(*map(F.lit, vs)))]
    return F.struct(
        F.lit(schema.get("type")).alias("type"),
        (F.lit(None) if required is None else F.array(*map(F.lit, required))).alias("required"),
        (F.lit(None) if enums is None else F.create_map(*pairs)).alias("enums"),
    ).cast(schemas.CHECK_SCHEMA)


def check_literal(
    kind: str, n: int | None = None, prefix: str | None = None, schema: dict | None = None
) -> Column:
    """A check as a literal column."""
    return F.struct(
        F.lit(kind).alias("type"),
        F.lit(n).cast("bigint").alias("n"),
        F.lit(prefix).cast("string").alias("prefix"),
        _schema_literal(schema).alias("schema"),
    )


def _one(df: DataFrame, check: Column, fields: tuple[str, ...]) -> DataFrame:
    source = df if "prompt" in df.columns else df.withColumn("prompt", F.lit(""))
    kept = [F.col(c) for c in df.columns if c not in ("checks", *fields)]
    checked = evaluate(source.withColumn("checks", F.array(check)))
    return checked.select(*kept, *[F.col("results")[0][f].alias(f) for f in fields])


def check_exact_bullets(df: DataFrame, n: int, prefix: str | None = None) -> DataFrame:
    fields = ("pass", "found_count", "expected", "prefix")
    return _one(df, check_literal(BULLETS, n, prefix), fields)


def check_first_n_questions(df: DataFrame, n: int) -> DataFrame:
    fields = ("pass", "reason", "found_count", "expected", "checked_lines")
    return _one(df, check_literal(QUESTIONS, n), fields)


def check_json_schema(df: DataFrame, schema: dict | None = None) -> DataFrame:
    fields = ("pass", "reason", "found_type", "missing", "details", "required_checked", "enums_checked")
    return _one(df, check_literal(JSON, schema=schema), fields)


# The parts of the checks

def count_bullets(df: DataFrame, prefix: str | None = None, col: str = "cleaned") -> DataFrame:
    text = F.col(col)
    found = (
        bullets.prefixed_count(lines(text), F.lit(prefix)) if prefix else bullets.bullet_count(text)
    )
    return df.withColumn("found", found)


def first_n_lines(df: DataFrame, n: int, col: str = "cleaned") -> DataFrame:
    return df.withColumn("lines", bullets.first_lines(lines(F.col(col)), F.lit(n)))


def extract_json_candidate(df: DataFrame, col: str = "cleaned") -> DataFrame:
    return df.withColumn("candidate", jsontext.candidate(F.col(col)))


def json_parses(df: DataFrame) -> DataFrame:
    """Add the parsed ``value`` of ``candidate`` and whether it parsed."""
    settings.ensure(df.sparkSession)
    df = df.withColumn("_tokens", jsontext.tokens(F.col("candidate")))
    return df.withColumn("value", jsontext.strict_value(F.col("candidate"), ts=F.col("_tokens"))).drop("_tokens").withColumn(
        "ok", F.isnotnull("value")
    )


def json_type_check(df: DataFrame, schema: dict) -> DataFrame:
    found = jsontext.type_name(F.col("candidate"))
    wrong = F.lit(schema.get("type") == "object") & F.col("ok") & (found != "dict")
    return df.withColumns({"reason": F.when(wrong, "wrong_type"), "found_type": F.when(wrong, found)})


def json_required_keys(df: DataFrame, schema: dict | None = None) -> DataFrame:
    """Objects only; an empty declaration falls back to the keys the prompt shows.

    ``keys`` may hold them (see ``infer_required_keys``), so that they are read
    once per prompt and its text is not joined to every answer.
    """
    settings.ensure(df.sparkSession)
    declared = (schema or {}).get("required")
    required = (
        F.array(*map(F.lit, declared))
        if declared
        else F.col("keys") if "keys" in df.columns else inference.required_keys(F.col("prompt"))
    )
    missing = jsontext.absent_keys(required, jsontext.members(F.col("value")))
    return df.withColumn("missing", missing).withColumn(
        "reason", F.when(F.size("missing") > 0, "missing_keys")
    )


def json_enum_check(df: DataFrame, schema: dict | None = None) -> DataFrame:
    """Objects and string values only; ``details`` holds the lists that were broken.

    ``enums`` may hold what the prompt shows (see ``infer_enums``).
    """
    settings.ensure(df.sparkSession)
    declared = (schema or {}).get("enums")
    enums = (
        F.create_map(*[x for k, vs in declared.items() for x in (F.lit(k), F.array(*map(F.lit, vs)))])
        if declared
        else F.col("enums") if "enums" in df.columns else inference.enums(F.col("prompt"))
    )
    breaches = jsontext.enum_breaches(enums, jsontext.members(F.col("value")))
    return df.withColumn("details", breaches).withColumn(
        "reason", F.when(F.cardinality("details") > 0, "enum_violation")
    )


def distinct_keys_in_order(df: DataFrame, col: str = "keys") -> DataFrame:
    return df.withColumn(col, F.array_distinct(col))


def missing_keys(df: DataFrame, required: str = "required", present: str = "present") -> DataFrame:
    """Required keys that are not present, in order."""
    have = F.col(present)
    return df.withColumn("missing", F.filter(required, lambda k: ~F.array_contains(have, k)))
