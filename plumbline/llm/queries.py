"""One registered query per operator: the operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import chat_format, decontaminate, divergence, html_extract, hyperminhash, token_alignment, line_dedup, mixing, oracle, pii, quality, simhash, token_files, toxicity
from plumbline.llm.common import stored, table
from plumbline.settings import scratch_path


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(chat_format.control_string_chat(spark))
    pieces = chat_format.format_records(chat_format.rows_as_records(rows))
    return chat_format.read_chats(stored(pieces, "chats"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = toxicity.held_out()
    return toxicity.toxicity(docs.select("doc_id", "text"), labels, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "toxicity.score", "toxicity.predicted", "toxicity.spans"
    )


def tokens_written_and_read(docs: DataFrame) -> DataFrame:
    path = scratch_path(docs.sparkSession, "tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_tokens(docs.sparkSession, path)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_written_and_read(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.quality_rules(docs, labels).select("doc_id", "quality_verdict.*")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents"))


def op13_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
        op1_pii,
        op2_mixing,
        op3_chat_format,
        op4_html_extract,
        op5_decontaminate,
        op6_toxicity,
        op7_token_files,
        op8_quality_rules,
        op9_line_dedup,
        op10_simhash,
        op11_divergence,
        op12_alignment,
        op13_hyperminhash,
    )}

ORACLE_SQL: dict[str, str] = {"op5_decontaminate": oracle.OP5, "op11_divergence": oracle.OP11}
