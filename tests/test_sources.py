"""Readers and writers."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline import schemas, settings
from plumbline.operators import checks, shaping, summary
from plumbline.plans import format_eval, preparation, preference_eval
from plumbline.sources import readers, writers


class Session:
    """As much of a session as the scratch folder asks for."""

    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder(tmp_path):
    shared = {"spark.checkpoint.dir": "hdfs://shared/"}
    assert settings.scratch_path(Session("yarn", **shared), "x").startswith("hdfs://shared/x-")
    with pytest.raises(RuntimeError):
        settings.scratch_path(Session("yarn"), "x")
    assert settings.scratch_path(Session("local[2]"), "x")


def test_splits_by_file_and_by_folder(spark, tmp_path):
    rows = spark.createDataFrame([("p1", "c1", "r1", "train"), ("p2", "c2", "r2", "test")], "prompt string, chosen string, rejected string, split string")
    rows.write.partitionBy("split").json(str(tmp_path / "all"))
    files = {s: str(tmp_path / "all" / f"split={s}") for s in ("train", "test")}
    for path in (str(tmp_path / "all"), files):
        read = lambda **kw: {
            (r.split, r.prompt)
            for r in readers.src_preferences(spark, path, fmt="json", schema=schemas.DPO_ROW, **kw).collect()
        }
        assert read() == {("train", "p1"), ("test", "p2")}
        assert read(splits=["test"]) == {("test", "p2")}
    one = readers.src_one_split(spark, str(tmp_path / "all"), fmt="json", schema=schemas.DPO_ROW)
    assert "PartitionFilters: [isnotnull(split" in one._jdf.queryExecution().toString()


def test_mixed_fields_from_json(spark, tmp_path):
    lines = [
        {"prompt": " q ", "chosen": [{"role": "user", "content": "q"}, {"role": "assistant", "content": " a "}], "rejected": "r"},
        {"prompt": "q", "chosen": "c", "rejected": []},
    ]
    path = tmp_path / "rows.json"
    path.write_text("\n".join(map(json.dumps, lines)))
    raw = readers.src_preferences(spark, {"train": str(path)}, fmt="json", schema=schemas.VARIANT_PAIR)
    got = {tuple(r) for r in shaping.build_preference_pairs(raw).collect()}
    assert got == {("q", "a", "r"), ("q", "c", None)}


def test_json_array_and_lines(spark, tmp_path):
    rows = [{"prompt": "a", "response": "b\nc"}, {"prompt": "d", "response": "é"}]
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    for name, multiline in (("array", True), ("lines", False)):
        df = readers.src_train_eval_json(spark, str(tmp_path / f"{name}.json"), multiline=multiline)
        assert {tuple(r) for r in df.collect()} == {("a", "b\nc", "train"), ("d", "é", "train")}


def test_malformed_prompts_fail(spark, tmp_path):
    path = tmp_path / "prompts.json"
    path.write_text('[{"id": "a", "prompt": }]')
    with pytest.raises(Exception, match="[Mm]alformed"):
        readers.src_prompt_items(spark, str(path)).collect()
    with pytest.raises(ValueError):
        readers.src_preferences(spark, {"train": str(path)}, fmt="json")


def test_prompt_items(spark, tmp_path):
    path = tmp_path / "prompts.json"
    item = {"id": "a", "prompt": "x", "checks": [{"type": "json_schema", "schema": {"type": "object", "required": ["k"], "enums": {"k": ["v"]}}}]}
    path.write_text(json.dumps([item, {"id": "b", "prompt": "y", "category": "c"}]))
    rows = {r.id: r for r in readers.src_prompt_items(spark, str(path)).collect()}
    assert rows["a"].checks[0].schema.enums == {"k": ["v"]} and rows["a"].category is None
    assert rows["b"].checks is None


def test_published_artifact_layout(spark, tmp_path):
    item = {
        "id": "a", "category": None, "prompt": "x",
        "outputs": {"base": {"det": "o", "samp": None}},
        "outputs_clean": {"base": {"det": "c"}},
        "auto_eval": {"base": {"det": {"pass_all": False, "checks": [{"type": "exact_bullets", "pass": False, "found": 1}]}}},
    }
    path = tmp_path / "run.json"
    path.write_text(json.dumps({"run_meta": {"batch_size": 8}, "items": [item]}, indent=2))
    rows = readers.src_generation_artifact(spark, str(path)).where("raw is not null").collect()
    (r,) = rows
    assert (r.id, r.model, r.variant, r.raw, r.cleaned, r.verdict.pass_all) == ("a", "base", "det", "o", "c", False)
    assert json.loads(r.verdict.checks)[0]["found"] == 1


def test_run_payload(spark, tmp_path):
    prompts = spark.createDataFrame(
        [("p", "c", "x", [("exact_bullets", 1, "- ", None)], None), ("q", None, "y", None, None)],
        schemas.PROMPT_ITEM,
    )
    answers = spark.createDataFrame([("p", "base", "det", "- é"), ("p", "sft", "det", "1. b")], schemas.GENERATION)
    done = format_eval.evaluated_answers(prompts, answers)
    out = str(tmp_path / "run")
    writers.sink_run_payload(prompts, done, summary.eval_summary(done), out, {"batch_size": 8, "seed": None})
    text = "".join(p.read_text() for p in (tmp_path / "run" / "items").glob("part-*"))
    items = {i["id"]: i for i in map(json.loads, text.splitlines())}
    assert "é" in text
    assert items["p"]["auto_eval"]["base"]["det"]["checks"][0]["pass"] is True
    assert items["p"]["rubric"] == {"notes": ""} and items["q"]["checks_inferred"] == []
    meta = "".join(p.read_text() for p in (tmp_path / "run" / "run_meta").glob("part-*"))
    assert json.loads(meta) == {"run_meta": {"batch_size": 8, "seed": None}}
    assert list((tmp_path / "run" / "auto_eval_summary").glob("part-*"))


def test_preparation_flow(spark, tmp_path):
    raw = spark.createDataFrame(
        [(" p ", [("user", "p"), ("assistant", " c")], [("assistant", "r ")])], schemas.MESSAGE_PAIR
    )
    assert preparation.prepare_training_sets(raw, str(tmp_path)) == {"sft": 1, "dpo": 1}
    dpo = spark.read.schema(schemas.DPO_ROW).json(str(tmp_path / "dpo"))
    assert tuple(dpo.first()) == ("p", "c", "r")


def test_evaluation_triplets(spark):
    raw = spark.createDataFrame(
        [(f"k{i}", " q", f"Assistant: c{i}", "`r") for i in range(100)],
        "pair_id string, prompt string, chosen string, rejected string",
    )
    rows = preference_eval.evaluation_triplets(raw, 10).collect()
    assert len(rows) == 10
    assert all((r.prompt, r.chosen, r.rejected) == ("q", "c" + r.pair_id[1:], "r") for r in rows)


def test_undeclared_checks_column(spark):
    df = spark.createDataFrame([("p", "x", None)], f"id string, prompt string, checks {schemas.CHECKS}")
    assert checks.declared_checks(df).select(F.size("checks")).first()[0] == 0


def test_items_shuffle_no_text_twice_and_keep_every_cleaned_text(spark):
    texts = {
        ("a", "base", "det"): ("Assistant: é\U0001f310 answer ", "é\U0001f310 answer"),
        ("a", "base", "samp"): ("x\r\ny", "x\ny"),  # not a part of its raw text
        ("a", "sft", "det"): (" \n", ""),
        ("a", "sft", "samp"): ("", ""),
        ("b", "dpo", "samp"): ("EM2. same", "same"),
    }
    evaluated = spark.createDataFrame(
        [(*key, raw, cleaned, True, []) for key, (raw, cleaned) in texts.items()],
        "id string, model string, variant string, raw string, cleaned string, pass_all boolean, results array<struct<type:string>>",
    )
    prompts = spark.createDataFrame([(i, None, "x", None, None) for i in "abc"], schemas.PROMPT_ITEM)
    items = {r.id: r for r in writers.run_items(prompts, evaluated).collect()}
    assert items["c"].outputs is None and items["c"].outputs_clean is None
    for i in "ab":
        for m in settings.MODELS:
            for v in settings.VARIANTS:
                assert (items[i].outputs[m][v], items[i].outputs_clean[m][v]) == texts.get((i, m, v), (None, None))
    # a long text and its cleaned form: the cleaned one does not cross the shuffle
    long = evaluated.select("id", "model", "variant", F.expr("repeat(raw, 3)").alias("raw"), F.expr("repeat(raw, 3)").alias("cleaned"), "pass_all", "results")
    plan = writers.run_items(prompts, long)._jdf.queryExecution().optimizedPlan().toString()
    assert "position" in plan.lower() or "locate" in plan.lower()


def test_run_payload_compressed(spark, tmp_path):
    prompts = spark.createDataFrame([("p", "c", "x" * 5000, None, None)], schemas.PROMPT_ITEM)
    answers = spark.createDataFrame([("p", m, v, "- é" * 2000) for m in settings.MODELS for v in settings.VARIANTS], schemas.GENERATION)
    done = format_eval.evaluated_answers(prompts, answers)
    out = {}
    for name in (None, "gzip"):
        path = str(tmp_path / f"run-{name}")
        writers.sink_run_payload(prompts, done, summary.eval_summary(done), path, {"n": 1}, compression=name)
        out[name] = sum(p.stat().st_size for p in (tmp_path / f"run-{name}" / "items").glob("part-*"))
        rows = readers.src_generation_artifact(spark, f"{path}/items", multiline=False).collect()
        assert len(rows) == 6 and all(r.raw == r.cleaned == "- é" * 2000 for r in rows)
    assert out["gzip"] * 10 < out[None]


def test_stored_artifact_is_compressed(spark, monkeypatch, tmp_path):
    from plumbline.plans import catalog, derived

    monkeypatch.setattr(settings, "scratch_path", lambda spark, name: str(tmp_path / name))
    docs = [(i, f"a text of {i} words", "en", "web", 10) for i in range(12)]
    spark.createDataFrame(docs, derived.TABLES["documents"]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], derived.TABLES["labels"]).write.parquet(str(tmp_path / "labels.parquet"))
    assert {r.id for r in catalog.src_generation_artifact(spark, str(tmp_path)).collect()} == {f"p{i}" for i in range(12)}
    assert list((tmp_path / "artifact").glob("part-*.json.gz"))
