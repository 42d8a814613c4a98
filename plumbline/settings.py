"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_RUNTIME = {
    # JSON objects and inferred enum lists keep the last of repeated keys.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Split the rows of a hot join key over tasks.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

MODELS = ("base", "sft", "dpo")
VARIANTS = ("det", "samp")


def ensure(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options; only those, so the caller's session stays its own."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table.

    It lies in the shared folder of ``spark.checkpoint.dir``. Only a local
    session that has no such folder may use the machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="plumbline-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
