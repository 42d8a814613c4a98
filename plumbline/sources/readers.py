"""Readers. Every source has a declared schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline import schemas
from plumbline.functions import jsontext
from plumbline.operators.shaping import union_splits
from plumbline.settings import MODELS, VARIANTS


def _reader(spark: SparkSession, fmt: str, schema: str | None, multiline: bool):
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "json":
        raise ValueError("JSON sources need a schema")
    if fmt == "json":
        reader = reader.option("multiLine", multiline).option("mode", "FAILFAST")
    return reader


def src_preferences(
    spark: SparkSession,
    path: str | Mapping[str, str],
    splits: list[str] | None = None,
    fmt: str = "parquet",
    schema: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """All splits of a preference dataset with their name in ``split``.

    ``path`` is a folder laid out as ``split=<name>/`` or a mapping from split
    name to files. In both forms unwanted splits are not read.
    """
    if isinstance(path, Mapping):
        parts = [
            _reader(spark, fmt, schema, multiline).load(p).withColumn("split", F.lit(name))
            for name, p in path.items()
            if splits is None or name in splits
        ]
        return union_splits(parts)
    if schema is not None:
        schema = f"{schema}, split string"
    df = _reader(spark, fmt, schema, multiline).load(path)
    df = df.withColumn("split", F.col("split").cast("string"))
    return df if splits is None else df.where(F.col("split").isin(*splits))


def src_one_split(spark: SparkSession, path, split: str = "train", **options) -> DataFrame:
    return src_preferences(spark, path, splits=[split], **options)


def src_train_eval_json(
    spark: SparkSession,
    train_path: str,
    eval_path: str | None = None,
    schema: str = schemas.SFT_ROW,
    multiline: bool = False,
) -> DataFrame:
    """Train file and optional eval file, told apart by ``part``.

    JSON lines split over tasks. A single JSON array (``multiline``) is one
    task per file and is read for compatibility.
    """
    paths = {"train": train_path} | ({"eval": eval_path} if eval_path else {})
    return union_splits(
        [
            _reader(spark, "json", schema, multiline).load(p).withColumn("part", F.lit(part))
            for part, p in paths.items()
        ]
    )


def json_file_errors(spark: SparkSession, path: str) -> DataFrame:
    """``file, message, line, column, position`` of every file under ``path`` that is not one JSON value.

    Each file is one row (its whole text, as a JSON document is), judged on
    the JVM by ``jsontext.first_error``: the message, 1-based line and column and
    0-based character position are those Python's decoder gives. Sound files
    give no row.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    fault = files.select("file", "value", jsontext.first_error(F.col("value")).alias("f")).where("f IS NOT NULL")
    place = jsontext.line_and_column(F.col("value"), F.col("f.position"))
    return fault.select("file", "f.message", place["line"].alias("line"), place["column"].alias("column"), F.col("f.position").alias("position"))


def src_prompt_items(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Prompt set. A malformed JSON document fails the read, naming file, line and column.

    Only the first malformed file (by name) reaches the driver, as one row.
    """
    if multiline:
        bad = json_file_errors(spark, path).orderBy("file").first()
        if bad is not None:
            raise ValueError(f"Invalid JSON in {bad.file}: {bad.message} at line {bad.line}, col {bad.column}")
    return _reader(spark, "json", schemas.PROMPT_ITEM, multiline).load(path)


def _per_model(leaf: str, models, variants) -> str:
    inner = ",".join(f"{v}:{leaf}" for v in variants)
    return "struct<" + ",".join(f"{m}:struct<{inner}>" for m in models) + ">"


def src_generation_artifact(
    spark: SparkSession,
    path: str,
    multiline: bool = True,
    models: tuple[str, ...] = MODELS,
    variants: tuple[str, ...] = VARIANTS,
) -> DataFrame:
    """Run artifact as a long table: one row per item, model and variant.

    ``multiline`` reads one JSON document with ``items``; otherwise each line
    is an item. Verdict details stay JSON text, as their keys vary by check.
    """
    fields = {
        "id": "string",
        "category": "string",
        "prompt": "string",
        "outputs": _per_model("string", models, variants),
        "outputs_clean": _per_model("string", models, variants),
        "auto_eval": _per_model("struct<pass_all:boolean,checks:string>", models, variants),
    }
    if multiline:
        item = ",".join(f"{name}:{kind}" for name, kind in fields.items())
        df = _reader(spark, "json", f"items array<struct<{item}>>", True).load(path)
        df = df.select(F.inline("items"))
    else:
        item = ",".join(f"{name} {kind}" for name, kind in fields.items())
        df = _reader(spark, "json", item, False).load(path)
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"),
                F.lit(v).alias("variant"),
                F.col(f"outputs.{m}.{v}").alias("raw"),
                F.col(f"outputs_clean.{m}.{v}").alias("cleaned"),
                F.col(f"auto_eval.{m}.{v}").alias("verdict"),
            )
            for m in models
            for v in variants
        ]
    )
    return df.select("id", "category", "prompt", F.inline(rows))
