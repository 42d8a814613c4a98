"""One query per operator over the given tables.

Results are scalar columns, so that another SQL engine can be compared with
them. Long texts are shown by their md5. Queries of sources and sinks write to
a fresh folder and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline import schemas, settings
from plumbline.functions.messages import ChatTemplate
from plumbline.functions.text import words
from plumbline.operators import (
    checks,
    filters,
    hooks,
    joins,
    ordering,
    preference,
    quality,
    sampling,
    shaping,
    summary,
)
from plumbline.operators.scale import lookup_join
from plumbline.plans import derived, format_eval, preference_eval, standins
from plumbline.sources import readers, writers
from plumbline.streaming import pass_rate

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MAX_PROMPT, MAX_COMPLETION = 1024, 256
SAMPLE = 100
BLOCK = 512
TEMPLATE = ChatTemplate()


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _long(c: str | Column, name: str) -> Column:
    return F.md5(F.col(c) if isinstance(c, str) else c).alias(name)


def _n(c: Column, name: str) -> Column:
    return c.cast("bigint").alias(name)


def _answers(spark: SparkSession, sf: str, infer: bool = False) -> DataFrame:
    return format_eval.evaluated_answers(
        derived.prompts(spark, sf), derived.generations(spark, sf), infer=infer
    )


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    answers = filters.drop_missing_outputs(derived.generations(spark, sf))
    return shaping.clean_outputs(answers).select("id", "model", "variant", "cleaned")


KEY = ("id", "model", "variant")


# Sources and sinks

def _stored_preferences(spark: SparkSession, sf: str) -> str:
    path = settings.scratch_path(spark, "preferences")
    rows = derived.pref_messages(spark, sf).select("split", "pair_id", "prompt", "chosen", "rejected")
    rows.write.partitionBy("split").parquet(path)
    return path


_PREFERENCES = f"pair_id string, {schemas.MESSAGE_PAIR}"


@query
def src_preferences(spark, sf):
    path = _stored_preferences(spark, sf)
    rows = readers.src_preferences(spark, path, schema=_PREFERENCES)
    return rows.select("split", "pair_id", "prompt", _n(F.size("chosen"), "turns"))


@query
def src_one_split(spark, sf):
    path = _stored_preferences(spark, sf)
    rows = readers.src_one_split(spark, path, "test", schema=_PREFERENCES)
    return rows.select("split", "pair_id", "prompt", _n(F.size("chosen"), "turns"))


@query
def src_train_eval_json(spark, sf):
    path = settings.scratch_path(spark, "sft")
    raw = derived.pref_messages(spark, sf)
    for part, split in (("train", "train"), ("eval", "test")):
        pairs = shaping.build_sft_pairs(raw.where(F.col("split") == split))
        writers.sink_pairs_json(pairs, f"{path}/{part}")
    rows = readers.src_train_eval_json(spark, f"{path}/train", f"{path}/eval")
    return rows.select("part", "prompt", "response")


@query
def src_prompt_items(spark, sf):
    path = settings.scratch_path(spark, "prompts")
    derived.prompts(spark, sf).select("id", "category", "prompt", "checks").write.json(path)
    rows = readers.src_prompt_items(spark, path, multiline=False)
    return rows.select(
        "id",
        "category",
        _long("prompt", "prompt_md5"),
        F.isnotnull("checks").alias("declared"),
        _n(F.size(F.coalesce("checks", F.array())), "n_checks"),
    )


@query
def src_generation_artifact(spark, sf):
    path = settings.scratch_path(spark, "artifact")
    prompts = filters.skip_categories(derived.prompts(spark, sf))
    writers.run_items(prompts, _answers(spark, sf)).write.json(path, compression="gzip")
    rows = readers.src_generation_artifact(spark, path, multiline=False)
    return filters.drop_missing_outputs(rows).select(
        *KEY,
        _long("raw", "raw_md5"),
        _long("cleaned", "cleaned_md5"),
        F.col("verdict.pass_all").alias("pass_all"),
    )


@query
def sink_pairs_json(spark, sf):
    path = settings.scratch_path(spark, "dpo")
    pairs = shaping.build_preference_pairs(derived.pref_messages(spark, sf))
    written = writers.sink_pairs_json(pairs, path)
    rows = spark.read.schema(schemas.DPO_ROW).json(path)
    return rows.select("prompt", "chosen", "rejected", F.lit(written).cast("bigint").alias("written"))


@query
def sink_run_payload(spark, sf):
    path = settings.scratch_path(spark, "run")
    prompts = filters.skip_categories(derived.prompts(spark, sf))
    # Judged once: items and summary are both built from the written table.
    judged = settings.scratch_path(spark, "judged")
    _answers(spark, sf).write.parquet(judged, compression="zstd")
    answers = spark.read.parquet(judged)
    writers.sink_run_payload(
        prompts, answers, summary.eval_summary(answers), path,
        {"batch_size": 8, "max_new_tokens": 256}, compression="gzip",
    )
    rows = readers.src_generation_artifact(spark, f"{path}/items", multiline=False)
    return rows.groupBy("id", "category").agg(
        F.count("raw").alias("outputs"),
        F.count_if("verdict.pass_all").alias("passed"),
        F.count("verdict.pass_all").alias("applicable"),
    )


@query
def sink_eval_summary(spark, sf):
    path = settings.scratch_path(spark, "summary")
    writers.sink_eval_summary(summary.eval_summary(_answers(spark, sf)), path)
    schema = "metric string, model string, check_type string, num bigint, den bigint, rate double"
    return spark.read.schema(schema).json(path)


@query
def sink_preference_report(spark, sf):
    path = settings.scratch_path(spark, "report")
    writers.sink_preference_report(
        _metrics(spark, sf).select("model", "n", "preference_accuracy", "avg_logp_margin", "ties"),
        path,
        {"dataset": "conversations", "max_prompt_tokens": MAX_PROMPT},
    )
    result = "struct<n:bigint,preference_accuracy:double,avg_logp_margin:double,ties:bigint>"
    report = spark.read.schema(
        f"dataset string, max_prompt_tokens int, results map<string,{result}>"
    ).json(path)
    return report.select(
        "dataset", "max_prompt_tokens", F.explode("results").alias("model", "m")
    ).select("dataset", "max_prompt_tokens", "model", "m.*")


# Shaping

@query
def last_message_text(spark, sf):
    lists = shaping.last_message_text(derived.pref_messages(spark, sf), "chosen")
    turns = shaping.last_turn_text(derived.read(spark, sf, "conversations"))
    return lists.select(F.lit("list").alias("form"), F.col("pair_id").alias("key"), "text").unionByName(
        turns.select(F.lit("turns").alias("form"), F.col("conv_id").cast("string").alias("key"), "text")
    )


@query
def last_user_message(spark, sf):
    lists = shaping.last_user_message(derived.pref_messages(spark, sf), "messages", "text")
    turns = shaping.last_turn_text(derived.read(spark, sf, "conversations"), user_only=True)
    return lists.select(F.lit("list").alias("form"), F.col("pair_id").alias("key"), "text").unionByName(
        turns.select(F.lit("turns").alias("form"), F.col("conv_id").cast("string").alias("key"), "text")
    )


@query
def normalize_preference_schema(spark, sf):
    raw = derived.pref_messages(spark, sf).select("pair_id", "messages", "chosen", "rejected")
    return shaping.normalize_preference_schema(raw)


@query
def build_sft_pairs(spark, sf):
    return shaping.build_sft_pairs(derived.pref_messages(spark, sf))


@query
def build_preference_pairs(spark, sf):
    return shaping.build_preference_pairs(derived.pref_messages(spark, sf))


@query
def render_chat_sft(spark, sf):
    return shaping.render_chat_sft(build_sft_pairs(spark, sf), TEMPLATE)


@query
def render_chat_prompt(spark, sf):
    prompts = derived.prompts(spark, sf).select("id", "prompt")
    plain = shaping.render_chat_prompt(prompts)
    templated = shaping.render_chat_prompt(prompts, TEMPLATE)
    return plain.select("id", F.lit("plain").alias("form"), _long("chat_prompt", "chat_md5")).unionByName(
        templated.select("id", F.lit("template").alias("form"), _long("chat_prompt", "chat_md5"))
    )


@query
def render_dpo_rows(spark, sf):
    return shaping.render_dpo_rows(derived.pref_pairs(spark, sf), TEMPLATE)


@query
def clean_outputs(spark, sf):
    cleaned = shaping.clean_outputs(derived.generations(spark, sf))
    return cleaned.select(*KEY, _n(F.char_length("cleaned"), "n_chars"), _long("cleaned", "cleaned_md5"))


@query
def clean_triplets(spark, sf):
    raw = derived.pref_messages(spark, sf)
    pairs = shaping.normalize_preference_schema(raw.select("pair_id", "prompt", "chosen", "rejected"))
    junk = pairs.withColumn("chosen", F.concat(F.lit(" limelight : "), "chosen"))
    return shaping.clean_triplets(junk)


@query
def rubric_scaffold(spark, sf):
    rows = shaping.rubric_scaffold(derived.prompts(spark, sf))
    return rows.select(
        "id", "rubric.notes", "rubric.winner", F.isnull("rubric.overall").alias("unrated")
    )


@query
def assemble_items(spark, sf):
    items = shaping.assemble_items(derived.prompts(spark, sf), derived.generations(spark, sf))
    return items.select(
        "id",
        "category",
        *[
            _long(f"outputs.{m}.{v}", f"{m}_{v}")
            for m in settings.MODELS
            for v in settings.VARIANTS
        ],
    )


# Filters

@query
def skip_categories(spark, sf):
    return filters.skip_categories(derived.prompts(spark, sf)).select("id", "category")


@query
def drop_missing_outputs(spark, sf):
    return filters.drop_missing_outputs(derived.generations(spark, sf)).select(*KEY)


@query
def select_variant(spark, sf):
    return filters.select_variant(derived.generations(spark, sf), "samp").select(*KEY, _long("raw", "raw_md5"))


@query
def skip_absent_models(spark, sf):
    return filters.skip_absent_models(derived.generations(spark, sf), ["dpo"]).select(*KEY)


@query
def applicable_only(spark, sf):
    return filters.applicable_only(checks.verdicts(_answers(spark, sf))).select(*KEY, "pass_all")


# Joins

@query
def join_prompts_outputs(spark, sf):
    rows = joins.join_prompts_outputs(derived.prompts(spark, sf), derived.generations(spark, sf))
    return rows.select(
        *KEY,
        _long("prompt", "prompt_md5"),
        _long("raw", "raw_md5"),
        _n(F.size(F.coalesce("checks", F.array())), "n_checks"),
    )


@query
def replay_lookup(spark, sf):
    outcome = F.array_join(
        F.transform("results", lambda r: F.concat(r["type"], F.lit("="), r["pass"].cast("string"))), ","
    )
    prompts = derived.prompts(spark, sf)
    answers = _answers(spark, sf).select(
        *KEY, "raw", F.struct("pass_all", outcome.alias("checks")).alias("verdict")
    )
    requests = prompts.select(
        "id", F.explode(F.array(*map(F.lit, settings.VARIANTS))).alias("variant"), "ord"
    )
    found = joins.replay_lookup(filters.skip_categories(prompts), answers, requests)
    return found.select(
        "id",
        "variant",
        _long("prompt", "prompt_md5"),
        *[_long(m, m) for m in settings.MODELS],
        "eval_text",
    )


@query
def join_chosen_rejected(spark, sf):
    return joins.join_chosen_rejected(completion_loglik(spark, sf))


# Aggregations

@query
def pass_all_rate(spark, sf):
    return summary.pass_all_rate(checks.verdicts(_answers(spark, sf)))


@query
def per_check_rate(spark, sf):
    return summary.per_check_rate(checks.check_results(_answers(spark, sf)))


@query
def wins_and_ties(spark, sf):
    answers = _answers(spark, sf)
    verdicts = checks.verdicts(filters.select_variant(answers))
    return summary.wins_and_ties(verdicts)


@query
def eval_summary(spark, sf):
    return summary.eval_summary(_answers(spark, sf))


@query
def completion_loglik(spark, sf):
    return preference.completion_loglik(derived.token_logprobs(spark, sf), MAX_PROMPT, MAX_COMPLETION)


def _metrics(spark, sf) -> DataFrame:
    return preference_eval.preference_metrics(
        derived.token_logprobs(spark, sf), MAX_PROMPT, MAX_COMPLETION, settings.MODELS
    )


@query
def preference_accuracy(spark, sf):
    return _metrics(spark, sf).select("model", "n", "preference_accuracy", "avg_logp_margin", "ties")


@query
def tie_aware_accuracy(spark, sf):
    return _metrics(spark, sf).select("model", "accuracy_excl_ties", "accuracy_w_ties_half")


@query
def dataset_row_counts(spark, sf):
    return summary.dataset_row_counts(derived.pref_pairs(spark, sf))


@query
def preference_margin_vs_reference(spark, sf):
    scores = join_chosen_rejected(spark, sf)
    model = F.col("model")
    rows = preference.preference_margin_vs_reference(
        scores.where(model == "dpo"), scores.where(model == "sft"), beta=0.0001
    )
    return rows.select(
        "pair_id",
        _n(F.round(F.col("margin") * 1e6), "margin_micro"),
        _n(F.round(F.col("loss") * 1e6), "loss_micro"),
    )


# Ordering

@query
def length_sorted_order(spark, sf):
    return ordering.length_sorted_order(derived.prompt_lengths(spark, sf), max_length=MAX_PROMPT).select(
        "id", "n_tokens", "rank"
    )


@query
def restore_order(spark, sf):
    ranked = ordering.length_sorted_order(derived.prompt_lengths(spark, sf), max_length=MAX_PROMPT)
    return ordering.restore_order(ranked).select("id", "ord", "rank")


@query
def length_sorted_batches(spark, sf):
    rows = ordering.length_sorted_batches(derived.prompt_lengths(spark, sf), max_length=MAX_PROMPT)
    return rows.select("id", "batch_id", "padded_len", "waste")


@query
def pack_sequences(spark, sf):
    rows = ordering.pack_sequences(derived.prompt_lengths(spark, sf), BLOCK)
    return rows.select(
        "block_id", "id", F.col("from").alias("from_token"), F.col("to").alias("to_token")
    )


@query
def length_buckets(spark, sf):
    rows = ordering.length_buckets(derived.prompt_lengths(spark, sf), 64)
    return ordering.group_by_bucket(rows).select("id", "n_tokens", "bucket")


# Sampling

@query
def train_test_split(spark, sf):
    return sampling.train_test_split(derived.pref_pairs(spark, sf), SAMPLE).select("pair_id", "part")


@query
def sample_n(spark, sf):
    return sampling.sample_n(derived.pref_pairs(spark, sf), SAMPLE).select("pair_id", "prompt", "chosen")


@query
def head_n(spark, sf):
    return sampling.head_n(derived.prompts(spark, sf), 100, "ord").select("id", "ord")


@query
def first_n_lines(spark, sf):
    rows = checks.first_n_lines(_cleaned(spark, sf), 3)
    return rows.select(*KEY, _n(F.size("lines"), "n_lines"), _long(F.array_join("lines", "\n"), "lines_md5"))


@query
def truncate_tokens(spark, sf):
    tokens = derived.prompts(spark, sf).select("id", words(F.col("prompt")).alias("tokens"))
    rows = sampling.truncate_tokens(tokens, 192)
    return rows.select("id", _n(F.size("tokens"), "n_tokens"), _long(F.array_join("tokens", " "), "tokens_md5"))


# Sets

@query
def union_splits(spark, sf):
    pairs = derived.pref_pairs(spark, sf).select("split", "pair_id", "prompt", "chosen")
    parts = [pairs.where(F.col("split") == s) for s in ("train", "test")]
    return shaping.union_splits(parts)


def _prompt_keys(spark, sf) -> DataFrame:
    prompts = derived.prompts(spark, sf)
    shown = F.regexp_extract_all("prompt", F.lit(r'"([A-Za-z_]+)"\s*:'), F.lit(1))
    return prompts.select("id", shown.alias("keys"))


@query
def distinct_keys_in_order(spark, sf):
    rows = checks.distinct_keys_in_order(_prompt_keys(spark, sf))
    return rows.select("id", F.array_join("keys", ",").alias("keys"))


@query
def missing_keys(spark, sf):
    rows = _prompt_keys(spark, sf).select(
        "id", F.array(F.lit("urgency"), F.lit("topic"), F.lit("intent")).alias("required"), "keys"
    )
    return checks.missing_keys(rows, "required", "keys").select(
        "id", F.array_join("missing", ",").alias("missing")
    )


# Format checks

@query
def count_bullets(spark, sf):
    rows = checks.count_bullets(_cleaned(spark, sf))
    rows = checks.count_bullets(rows.withColumnRenamed("found", "plain"), "- ")
    return rows.select(*KEY, "plain", F.col("found").alias("dashed"))


@query
def check_exact_bullets(spark, sf):
    rows = checks.check_exact_bullets(_cleaned(spark, sf), 3, "- ")
    return rows.select(*KEY, "pass", "found_count", "expected", "prefix")


@query
def check_first_n_questions(spark, sf):
    rows = checks.check_first_n_questions(_cleaned(spark, sf), 2)
    return rows.select(
        *KEY, "pass", "reason", "found_count", "expected",
        _long(F.array_join("checked_lines", "\n"), "lines_md5"),
    )


@query
def extract_json_candidate(spark, sf):
    rows = checks.extract_json_candidate(_cleaned(spark, sf))
    return rows.select(*KEY, "candidate")


def _parsed(spark, sf) -> DataFrame:
    return checks.json_parses(checks.extract_json_candidate(_cleaned(spark, sf)))


@query
def json_parses(spark, sf):
    return _parsed(spark, sf).select(*KEY, "ok")


@query
def json_type_check(spark, sf):
    return checks.json_type_check(_parsed(spark, sf), derived.TICKET).select(*KEY, "reason", "found_type")


@query
def json_required_keys(spark, sf):
    keys = checks.infer_required_keys(derived.prompts(spark, sf)).select("id", "keys")
    rows = checks.json_required_keys(lookup_join(_parsed(spark, sf), keys, ["id"]))
    return rows.select(*KEY, F.array_join("missing", ",").alias("missing"), "reason")


@query
def json_enum_check(spark, sf):
    enums = checks.infer_enums(derived.prompts(spark, sf)).select("id", "enums")
    rows = checks.json_enum_check(lookup_join(_parsed(spark, sf), enums, ["id"]))
    names = F.array_join(F.array_sort(F.map_keys("details")), ",")
    return rows.select(*KEY, names.alias("broken"), "reason")


@query
def check_json_schema(spark, sf):
    # The schema declares all, so no prompt is needed
    rows = checks.check_json_schema(_cleaned(spark, sf), derived.TICKET)
    return rows.select(
        *KEY, "pass", "reason", "found_type",
        F.array_join("missing", ",").alias("missing"),
        F.array_join(F.array_sort(F.map_keys("details")), ",").alias("broken"),
    )


@query
def run_checks(spark, sf):
    answers = format_eval.evaluated_answers(
        derived.prompts(spark, sf), derived.generations(spark, sf), skip=()
    )
    results = checks.check_results(answers)
    return results.select(*KEY, "type", "pass", "reason", "found_count", "found_type", "expected")


def _listed(rows: DataFrame) -> DataFrame:
    names = F.transform("checks", lambda c: F.concat_ws(":", c["type"], c["n"], c["prefix"]))
    return rows.select("id", F.array_join(names, ",").alias("checks"))


@query
def declared_checks(spark, sf):
    return _listed(checks.declared_checks(derived.prompts(spark, sf)))


# Inference

@query
def infer_exact_bullets(spark, sf):
    return checks.infer_exact_bullets(derived.prompts(spark, sf)).select("id", "n")


@query
def infer_first_n_questions(spark, sf):
    return checks.infer_first_n_questions(derived.prompts(spark, sf)).select("id", "n")


@query
def infer_json_check(spark, sf):
    return checks.infer_json_check(derived.prompts(spark, sf)).select("id", "flag")


@query
def infer_required_keys(spark, sf):
    rows = checks.infer_required_keys(derived.prompts(spark, sf))
    return rows.select("id", F.array_join("keys", ",").alias("keys"))


@query
def infer_enums(spark, sf):
    rows = checks.infer_enums(derived.prompts(spark, sf))
    entries = F.transform(
        F.map_entries("enums"), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], "|"))
    )
    return rows.select("id", F.array_join(F.array_sort(entries), ",").alias("enums"))


@query
def infer_checks(spark, sf):
    undeclared = derived.prompts(spark, sf).withColumn(
        "checks", F.when(F.size("checks") == 0, F.col("checks"))
    )
    return _listed(checks.infer_checks(undeclared))


# Data quality

@query
def validate_required_keys(spark, sf):
    lines = derived.prompts(spark, sf).select(
        F.col("ord").alias("row"), F.to_json(F.struct("id", "category", "prompt")).alias("value")
    )
    return quality.validate_required_keys(lines, ["id", "prompt", "category", "rubric"])


@query
def schema_gate(spark, sf):
    pairs = derived.pref_pairs(spark, sf)
    lines = pairs.select(
        F.col("ord").alias("row"),
        F.to_json(
            F.struct("prompt", "chosen", F.nullif("rejected", "chosen").alias("rejected"))
        ).alias("value"),
    )
    sets = {"sft": ["prompt", "response"], "dpo": ["prompt", "chosen", "rejected"]}
    return quality.schema_gate(lines, sets)


# Hooks, with stand-ins for the model

@query
def batch_generate(spark, sf):
    prompts = derived.prompts(spark, sf).select("id", "ord", "prompt")
    chat = shaping.render_chat_prompt(prompts).drop("prompt")
    # Batches are planned on lengths; the texts join their batch once
    lengths = chat.select("id", "ord", _n(F.size(words(F.col("chat_prompt"))), "n_tokens"))
    planned = ordering.length_sorted_batches(lengths, max_length=MAX_PROMPT).select("id", "batch_id")
    batches = chat.join(planned, "id")
    return hooks.batch_generate(batches, standins.digest_model, variants=settings.VARIANTS)


@query
def batch_score(spark, sf):
    pairs = derived.pref_pairs(spark, sf).withColumn("chat_prompt", F.col("prompt"))
    tokens = hooks.batch_score(pairs, standins.length_scorer)
    sums = preference.completion_loglik(tokens, MAX_PROMPT, MAX_COMPLETION)
    return sums.withColumn("logp", F.col("logp").cast("bigint"))


@query
def ngram_token_logp(spark, sf):
    pairs = derived.pref_pairs(spark, sf)
    sides = pairs.select(
        "pair_id",
        F.explode(
            F.create_map(F.lit("chosen"), F.col("chosen"), F.lit("rejected"), F.col("rejected"))
        ).alias("side", "text"),
    )
    train = pairs.where(F.col("split") == "train").select("pair_id", F.col("chosen").alias("text"))
    scored = preference.ngram_token_logp(
        preference.word_tokens(sides, ["pair_id", "side"]),
        preference.word_tokens(train, ["pair_id"]),
    )
    micro = F.round(F.col("logp") * 1e6).cast("bigint")
    return scored.groupBy("pair_id", "side").agg(
        F.count(F.lit(1)).alias("n"), F.sum(micro).alias("logp_micro")
    )


# Streaming

@query
def stream_pass_rate(spark, sf):
    declared = checks.resolve_checks(derived.prompts(spark, sf)).select("id", "checks")
    arrived = derived.generations(spark, sf).select(
        *KEY, "raw", F.timestamp_seconds(F.col("ord") * 60).alias("arrived")
    )
    rates = pass_rate.replay(arrived, declared, settings.scratch_path(spark, "stream"))
    return rates.withColumn("window_start", F.unix_seconds("window_start"))
