"""The pipeline's stages, and the registered queries against DuckDB."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import compare
import corpus_pipeline as pipeline
from plumbline.llm import decontaminate, mixing, quality, simhash

SF = "/root/testdata/sf0.001"


def test_oracle_rows(spark):
    con = compare.connect(SF)
    for name in ("op5_decontaminate",):
        assert compare.differences(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) == []


def test_all_queries_are_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert contract.queries()["pipeline"] is pipeline.run


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stages = dict(pipeline.STAGES)

    good = stages["quality_rules"](spark, docs, SF).cache()
    verdicts = quality.quality_rules(docs, labels)
    assert ids(good) == ids(verdicts.where("quality_verdict.kept")) and good.columns == docs.columns

    single = stages["near_duplicates"](spark, good, SF).cache()
    assert ids(single) == ids(simhash.near_duplicates(good).where("doc_id = component_id"))

    clean = stages["decontamination"](spark, single, SF).cache()
    assert ids(clean) == ids(decontaminate.report(single, bench).where("not contaminated"))

    mixed = stages["mixing"](spark, clean, SF).cache()
    taken = mixing.mix_report(clean).where("size > 0").select("doc_id", (F.col("taken") / F.col("size")).cast("int").alias("n"))
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert times == {r.doc_id: r.n for r in taken.collect() if r.n} and mixed.columns == docs.columns

    files = stages["token_files"](spark, mixed, SF)
    assert ids(files) == ids(mixed)


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


@pytest.mark.parametrize("name", ["op1_pii", "op6_toxicity", "op8_quality_rules"])
def test_one_row_per_document(spark, name):
    rows = contract.queries()[name](spark, SF)
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
