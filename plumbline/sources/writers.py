"""Writers. Output is split over tasks; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from plumbline.operators.shaping import by_model_and_variant, rubric_scaffold
from plumbline.settings import MODELS, VARIANTS


def sink_pairs_json(df: DataFrame, path: str, fmt: str = "json") -> int:
    """Write a training set; the row count comes out of the same job."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.format(fmt).option("ignoreNullFields", False).save(path)
    return seen.get["n"]


def run_items(
    prompts: DataFrame,
    evaluated: DataFrame,
    models: tuple[str, ...] = MODELS,
    variants: tuple[str, ...] = VARIANTS,
) -> DataFrame:
    """One nested row per prompt: outputs, cleaned outputs and verdicts.

    A cleaned text that stands in its raw one crosses the shuffle as its place
    there and is cut out again behind it; any other travels whole.
    """
    at = F.position("cleaned", "raw")
    text = F.struct(
        "raw",
        F.when(at > 0, at).alias("at"),
        F.when(at > 0, F.char_length("cleaned")).alias("n"),
        F.when(F.coalesce(at, F.lit(0)) == 0, F.col("cleaned")).alias("other"),
    )
    verdict = F.struct(F.col("pass_all"), F.col("results").alias("checks"))
    per_prompt = evaluated.groupBy("id").agg(
        by_model_and_variant(text, models, variants).alias("_texts"),
        by_model_and_variant(verdict, models, variants).alias("auto_eval"),
    )

    def of_each(value: Callable[[Column], Column]) -> Column:
        return F.struct(
            *[
                F.struct(*[value(F.col(f"_texts.{m}.{v}")).alias(v) for v in variants]).alias(m)
                for m in models
            ]
        )

    per_prompt = per_prompt.select(
        "id",
        of_each(lambda t: t["raw"]).alias("outputs"),
        of_each(
            lambda t: F.when(t["at"] > 0, F.substring(t["raw"], t["at"], t["n"])).otherwise(t["other"])
        ).alias("outputs_clean"),
        "auto_eval",
    )
    base = prompts.select(
        "id", "category", "prompt", F.coalesce("checks", F.array()).alias("checks_inferred")
    )
    return rubric_scaffold(base.join(per_prompt, "id", "left"))


def sink_run_payload(
    prompts: DataFrame,
    evaluated: DataFrame,
    summary: DataFrame,
    path: str,
    meta: dict,
    compression: str | None = None,
) -> None:
    """Items, summary and run metadata as three JSON tables under ``path``.

    An item holds up to 13 texts that are much alike; with a ``compression``
    (``gzip``) its files are a fraction of the plain ones. Readers tell it by
    the file name.

    ``evaluated`` feeds the items and, in most uses, the summary too; pass a
    written table, so that answers are judged once.
    """
    run_items(prompts, evaluated).write.json(f"{path}/items", compression=compression)
    sink_eval_summary(summary, f"{path}/auto_eval_summary")
    spark = prompts.sparkSession
    record = F.struct(*[F.lit(v).alias(k) for k, v in meta.items()])
    spark.range(1).select(record.alias("run_meta")).write.option("ignoreNullFields", False).json(
        f"{path}/run_meta"
    )


def sink_eval_summary(summary: DataFrame, path: str) -> None:
    summary.write.option("ignoreNullFields", False).json(path)


def sink_preference_report(metrics: DataFrame, path: str, params: dict) -> None:
    """Run parameters and the metrics of each model as one record.

    ``metrics`` has one row per model, so the collected map has as many
    entries as there are models.
    """
    fields = [c for c in metrics.columns if c != "model"]
    entry = F.struct("model", F.struct(*fields).alias("metrics"))
    report = metrics.agg(F.map_from_entries(F.collect_list(entry)).alias("results"))
    report.select(*[F.lit(v).alias(k) for k, v in params.items()], "results").write.option(
        "ignoreNullFields", False
    ).json(path)
