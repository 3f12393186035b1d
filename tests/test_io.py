import json

import pytest
import zstandard
from pyspark.sql import functions as F

from loomline.operators import labeling as B
from loomline.plans.catalog import ORACLE, QUERIES
from loomline.schema import SCORED
from loomline.sources import readers as R
from loomline.sources import writers as W
from loomline.streaming.incremental import grow_vocabulary, process_new, resume

SMALL = "id string, text string"


def put(path, *lines, mode="w"):
    path.write_bytes(b"\n".join(x if isinstance(x, bytes) else x.encode() for x in lines) + b"\n")
    return str(path)


def test_jsonl_zst_and_dispatch(spark, tmp_path):
    plain = put(tmp_path / "a.jsonl", '{"id": "1", "text": "é"}', "", '{"id": "2", "text": null}')
    assert R.read_corpus(spark, plain, SMALL).count() == 2
    z = tmp_path / "b.jsonl.zst"
    z.write_bytes(zstandard.ZstdCompressor().compress(b'{"id": "3", "text": "z"}\n'))
    assert R.read_corpus(spark, str(z), SMALL, partitions=2).first().text == "z"
    with pytest.raises(ValueError):
        R.read_corpus(spark, "x.doc")
    bad = put(tmp_path / "c.jsonl", '{"id": "1"', '{"id": "2", "text": "t"}')
    with pytest.raises(Exception):
        R.read_jsonl(spark, bad, SMALL).collect()
    raw = put(tmp_path / "d.jsonl", b'{"id": "1", "text": "a\xffb"}')
    assert R.read_jsonl_lossy(spark, raw, SMALL).first().text == "ab"


def test_validation(spark, tmp_path):
    rows = ['{"id": "1", "text": "t", "line_quality": "[0.1]"}', '{"id": "2", "text": "t"}', "{broken", '{"id": "3", "text": "a\tb", "line_quality": "[0.1, 0.2]"}', "", '{"id": "4", "line_quality": "oops"}']
    good, bad = R.read_validated(spark, put(tmp_path / "v.jsonl", *rows), SCORED)
    assert sorted(r.id for r in good.collect()) == ["1", "3"] and bad.count() == 3


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("1", "a\n\"q\"", None), ("2", "é", "x")], "id string, text string, extra string")
    W.write_jsonl(df, str(tmp_path / "out"))
    line = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())[0]
    assert json.loads(line) == {"id": "1", "text": "a\n\"q\"", "extra": None}
    W.write_csv(spark.createDataFrame([("a\nb,\"c\"", "High", 1.5)], "text string, nemotron_label string, hplt_doc_score double"), str(tmp_path / "csv"))
    assert R.read_predictions(spark, str(tmp_path / "csv")).first().text == "a\nb,\"c\""
    W.write_vocabulary(spark.createDataFrame([("a", 1), ("b", 5)], "label string, n long"), str(tmp_path / "voc"))
    assert [r.label for r in R.read_vocabulary(spark, str(tmp_path / "voc")).collect()] == ["b", "a"]
    W.write_parts(spark.range(10), str(tmp_path / "parts"), 3, "id")
    assert spark.read.json(str(tmp_path / "parts")).groupBy("part").count().orderBy("part").collect()[0]["count"] == 4
    assert W.base_name("/x/y.jsonl.zst") == "y" and W.plain_name("a.jsonl.zst") == "a.jsonl"
    W.write_settings(spark, str(tmp_path / "set"), threshold=0.8)
    assert json.loads(spark.read.text(str(tmp_path / "set")).first().value) == {"threshold": 0.8}


def test_concatenate(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text("3\n4")
    (tmp_path / "a.jsonl").write_text("1\n2\n")
    W.concatenate(spark, [str(tmp_path / "b.jsonl"), str(tmp_path / "a.jsonl")], str(tmp_path / "all"))
    assert [r.value for r in spark.read.text(str(tmp_path / "all")).collect()] == ["1", "2", "3", "4"]


def test_streaming_reads_new_files_only(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    put(src / "1.jsonl", '{"id": "1", "text": "a"}')
    keep = lambda df: df.where(F.col("text") != "")
    for k in (2, 3):
        process_new(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"), keep, SMALL)
        assert spark.read.json(str(tmp_path / "out")).count() == k - 1
        put(src / f"{k}.jsonl", f'{{"id": "{k}", "text": "b"}}')
    done = spark.read.json(str(tmp_path / "out"))
    assert [r.id for r in resume(spark.read.schema(SMALL).json(str(src)), done, keep).collect()] == ["3"]
    vocab = spark.createDataFrame([("old", 1)], "label string, n long")
    state = []
    save = lambda v: state.append(v.collect()) or spark.createDataFrame(state[-1], "label string, n long")
    final = grow_vocabulary(spark, str(src), str(tmp_path / "ck2"), SMALL, lambda b, v: b.select(F.lit("junk").alias("label")), vocab, save)
    assert {r.label: r.n for r in final.collect()} == {"old": 1, "junk": 3} and len(state) == 3


def test_labelling(spark):
    assert json.loads(B.repair_json('```json {"Line 1": "Clean", "Line 2": "Spam",}')) == {"Line 1": "Clean", "Line 2": "Spam"}
    assert json.loads(B.repair_json('{"Line 1": "Clean"')) == {"Line 1": "Clean"} and B.repair_json("nothing") is None and B.repair_json(None) is None
    df = spark.createDataFrame([(["a", "b", "c"], ["clean", "odd"]), (["a"], ["Clean", "Clean"]), (None, ["Clean"]), (["a"], None)], "l array<string>, q array<string>")
    got = [r[0] for r in df.select(B.attach(F.col("l"), F.col("q"))).collect()]
    assert [[c.label for c in x] if x is not None else None for x in got] == [["Clean"] * 3, ["Clean"], None, ["Clean"]]
    assert [len(r[0]) if r[0] is not None else None for r in df.select(B.attach(F.col("l"), F.col("q"), compat=True)).collect()] == [2, 1, None, 0]
    lines = spark.createDataFrame([("x",), ("x",), (" Clean",), (None,), ("y",)], "label string")
    assert {r.label: r.n for r in B.vocabulary(lines).collect()} == {"x": 2, "y": 1}
    assert [r.label for r in B.top_labels(B.vocabulary(lines), -1).collect()] == ["x", "y"]
    calls = []

    def flaky():
        state = {"n": 0}

        def model(texts):
            state["n"] += 1
            return ["bad" if state["n"] == 1 else "good"] * len(texts)

        return model

    asked = B.run_model(spark.createDataFrame([("p",)], "prompt string"), flaky, check=lambda t: t == "good")
    assert asked.first().output == "good" and calls == []


def test_catalogue():
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) > 50


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_sql(spark, name):
    import os

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    from tests.oracle import compare

    assert compare(spark, sf, QUERIES[name](spark, sf), ORACLE[name]) == ""
