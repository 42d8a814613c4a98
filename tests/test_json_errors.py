"""Line and column of malformed JSON files against Python's decoder, over damaged files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import jsontext
from plumbline.sources import readers
from test_json_exact import mutated


def python_error(text):
    try:
        json.loads(text)
        return None
    except json.JSONDecodeError as e:
        return (e.msg, e.pos, e.lineno, e.colno)


def test_first_error_agrees_with_python(spark):
    texts = mutated(3000, 5) + [
        "", " ", "[", "[1, 2", '{"a" 1}', '{"a":1,}', "[1,]", '"abc', '"a\x01b"', '"a\\qb"', '"a\\u12"', '"a\\u12zz"',
        '"a\\', "tru", "[1] x", "01", "-", "[-]", "1.", "[1.]", "nan", "-Infinit", '{"a":\n  [1,\n   2,,\n]}',
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string")
    f = jsontext.first_error(F.col("t"))
    place = jsontext.line_and_column(F.col("t"), f["position"])
    got = {
        r.i: (None if r.m is None else (r.m, r.p, r.l, r.c))
        for r in df.select("i", f["message"].alias("m"), f["position"].alias("p"), place["line"].alias("l"), place["column"].alias("c")).collect()
    }
    wrong = [(t, got[i], python_error(t)) for i, t in rows if got[i] != python_error(t)]
    assert wrong == []


def test_prompt_file_names_file_line_and_column(spark, tmp_path):
    good = [{"id": "a", "category": "x", "prompt": "p"}]
    (tmp_path / "a.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "b.json").write_text('[\n  {"id": "b",\n   "prompt": "q"\n  ,}\n]')
    with pytest.raises(ValueError) as e:
        readers.src_prompt_items(spark, str(tmp_path))
    err = python_error((tmp_path / "b.json").read_text())
    assert str(e.value).endswith(f"b.json: {err[0]} at line {err[2]}, col {err[3]}")
    (tmp_path / "b.json").write_text(json.dumps(good))
    assert readers.src_prompt_items(spark, str(tmp_path)).count() == 2
