"""Shared pieces of the training-data operators: tables, words, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.settings import scratch_path

#: Words between white space, as a Java pattern; bytes.split() cuts at the same bytes.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Lower-cases A-Z and blanks every ASCII byte that is no letter or digit.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
#: Arrow batches handed to Python are cut to about this many bytes of text.
BATCH_BYTES = 16 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    On a cluster without a shared installation, ship it by ``--py-files``.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def thinned(df: DataFrame, rows: int, key: str) -> DataFrame:
    """``df`` cut by a hash of ``key`` to about twice ``rows`` different keys, all rows of each.

    What a sample of the ``rows`` smallest hashes is then ordered from does not
    grow with the table. A smaller table stays whole.
    """
    h = F.xxhash64(key)
    keys = df.select(h.alias("h")).distinct().count()
    if keys <= 2 * rows:
        return df
    return df.where(h < F.lit(int((2 * rows / keys) * 2**64) - 2**63))


def as_bytes(texts: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, one at a time; null gives none."""
    for text in texts.cast(pa.large_binary()):
        yield text.as_py() or b""


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice holds much more text than ``BATCH_BYTES``."""
    rows = max(1, int(batch.num_rows * BATCH_BYTES / max(1, batch.column(column).nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def digest(column: Column) -> Column:
    return F.sha2(F.encode(column, "UTF-8"), 256)
