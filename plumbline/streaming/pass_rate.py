"""Pass rate over answers as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.operators.checks import judge
from plumbline.operators.filters import drop_missing_outputs
from plumbline.operators.shaping import clean_outputs


def judged_stream(answers: DataFrame, checks: DataFrame) -> DataFrame:
    """Stream of answers with verdicts; ``checks`` is a static table of complete checks."""
    return judge(clean_outputs(drop_missing_outputs(answers).join(checks, "id")))


def windowed_pass_rate(
    judged: DataFrame, width: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """Passed and applicable answers per window and model.

    State is two counters per window and model; the watermark lets closed
    windows go.
    """
    return (
        judged.withWatermark("arrived", delay)
        .groupBy(F.window("arrived", width).alias("w"), "model")
        .agg(F.count_if("pass_all").alias("passed"), F.count("pass_all").alias("applicable"))
        .select(F.col("w.start").alias("window_start"), "model", "passed", "applicable")
    )


def start(rates: DataFrame, path: str, checkpoint: str):
    """Keep the changed windows of every micro-batch, one folder per batch.

    A batch that is run again overwrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        rates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )


def latest(spark, path: str) -> DataFrame:
    """The newest counts of every window."""
    schema = "window_start timestamp, model string, passed bigint, applicable bigint, batch bigint"
    rows = spark.read.schema(schema).parquet(path)
    newest = F.max_by(F.struct("passed", "applicable"), "batch").alias("v")
    return rows.groupBy("window_start", "model").agg(newest).select("window_start", "model", "v.*")


def replay(answers: DataFrame, checks: DataFrame, folder: str) -> DataFrame:
    """Send a stored table of answers through the stream; ``folder`` is new and shared by all executors."""
    spark = answers.sparkSession
    source, out = f"{folder}/arrived", f"{folder}/rates"
    answers.write.parquet(source)
    stream = spark.readStream.schema(answers.schema).parquet(source)
    run = start(
        windowed_pass_rate(judged_stream(stream, checks)),
        out,
        f"{folder}/checkpoint",
    )
    run.awaitTermination()
    return latest(spark, out)
