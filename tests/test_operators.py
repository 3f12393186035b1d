"""Plans that evaluate a mask once, exact quartiles, the trainer, synonym review and what depends on the session."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline import session
from loomline.operators import analysis as A
from loomline.operators import labeling as B
from loomline.operators import quality as Q
from loomline.operators import scoring as R
from loomline.operators import synonyms as S
from loomline.operators import training as T
from loomline.operators.mask import mask
from loomline.schema import parse_labels


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_and_masks_stand_once_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a line of words that is long enough\n###")], "doc_id int, text string")
    out = mask(R.annotate_by_rules(docs), ["line_quality_labels"], lambda z: z["line_quality_labels"] == "Clean", leave=Q.filled)
    assert plan(out).count("RLIKE") == len(R.RULES) and out.first().text == "a line of words that is long enough"
    pages = spark.createDataFrame([("x\ny", ["Clean", "Clean"], [0.9, 0.1]), ("z", ["Clean"], [0.1]), (None, None, None), ("", [], [])], "text string, line_quality_labels array<string>, quality_scores array<double>")
    kept = Q.by_score(pages, 0.8)
    assert plan(kept).count("split(") <= 1 and [r.text for r in kept.collect()] == ["x"] and "Exchange" not in plan(kept)
    assert sorted(r.text for r in Q.by_label(pages, parse_labels("all")).collect()) == ["x\ny", "z"]


def test_box_stats_equals_numpy_whatever_the_skew(spark):
    rng = np.random.default_rng(2)
    rows = [("big", float(x)) for x in rng.integers(0, 50, 900)] + [("one", 3.0), ("two", 1.0), ("two", 4.0), (None, 2.0), ("two", None)]
    got = {r.k: r for r in A.box_stats(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()}
    big = np.array([v for k, v in rows if k == "big"])
    assert np.allclose([got["big"].q1, got["big"].median, got["big"].q3], np.quantile(big, [0.25, 0.5, 0.75])) and got["big"].n == 900
    assert (got["one"].q1, got["one"].q3, got["two"].median) == (3.0, 3.0, 2.5) and set(got) == {"big", "one", "two"}
    assert A.box_stats(spark.createDataFrame([], "k string, v double"), "k", "v").count() == 0


def test_smoothed_loss_is_cross_entropy():
    logits, codes = np.array([[2.0, 0.0, -1.0], [0.0, 0.0, 0.0]]), np.array([0, 2])
    loss, grad = T.smoothed_loss(logits, codes, np.array([1.0, 1.0, 2.0]), 0.0)
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    assert np.allclose(loss, [-np.log(p[0, 0]), -2 * np.log(p[1, 2])]) and np.allclose(grad[0], p[0] - [1, 0, 0])
    for smoothing in (0.0, 0.1):
        _, grad = T.smoothed_loss(logits, codes, np.array([1.0, 0.5, 2.0]), smoothing)
        near = logits.copy()
        near[0, 1] += 1e-6
        step = T.smoothed_loss(near, codes, np.array([1.0, 0.5, 2.0]), smoothing)[0][0] - T.smoothed_loss(logits, codes, np.array([1.0, 0.5, 2.0]), smoothing)[0][0]
        assert abs(step / 1e-6 - grad[0, 1]) < 1e-4


def test_training_stops_and_gives_the_best_model_back(spark):
    train = spark.createDataFrame([(w, c) for c, some in enumerate((["good text here", "fine text"], ["buy now", "cheap deal now"])) for w in some for _ in range(5)] + [(None, 0), ("x", None)], "text string, code int")
    model = T.train_classifier(train, train, 2, {0: 1.0, 1: 1.0}, features=256, steps=10, every=2)
    losses = [x for _, x in model.history]
    assert losses[-1] < losses[0] and [r.guess for r in model.predict(spark.createDataFrame([("good fine",), ("buy cheap",)], "text string")).collect()] == [0, 1]
    other = spark.createDataFrame([("buy now", 0), ("good text here", 1)], "text string, code int")
    stopped = T.train_classifier(train, other, 2, features=256, steps=40, every=1, patience=2)
    assert len(stopped.history) < 40 and not np.allclose(stopped.weights, 0)
    assert T.train_classifier(train.limit(0), train.limit(0), 2, features=16, steps=2, every=1).weights.shape == (16, 2)


def test_synonyms_are_reviewed_and_rewritten_in_earlier_results(spark):
    groups = spark.createDataFrame([("ads", ["ads", "advert"]), ("menu", ["menu"]), ("odd", ["odd", "strange"])], "name string, words array<string>")
    answers = {"ads, advert": 'Here: {"advertising": ["ads", "advert"]}', "odd, strange": "no idea"}
    make = lambda: lambda prompts: [next(v for k, v in answers.items() if k in p) for p in prompts]
    got = {r.name: r.words for r in S.review(groups, make).collect()}
    assert got == {"advertising": ["ads", "advert"], "menu": ["menu"], "odd": ["odd", "strange"]}
    assert S.repair_groups('x {"a": ["b"]} y') == '{"a": ["b"]}' and S.repair_groups("{") is None and S.repair_groups('{"a": "b"}') is None and S.repair_groups(None) is None
    content = "content array<struct<line: string, label: string>>"
    results = spark.createDataFrame([([("l", "advert text")],), ([("m", "Clean")],), (None,)], content)
    before = spark.createDataFrame([([("l", "adverts text")],)], content)
    unite = lambda: lambda prompts: ['{"ads": ["advert text", "adverts text"]}' for _ in prompts]
    now, earlier, mapping = S.merge_synonyms(results, before, before.select(F.col("content")[0].label.alias("label")), unite, threshold=0.9)
    assert mapping.count() == 2 and [c.label for r in now.collect() for c in r.content or []] == ["ads", "Clean"] and earlier.first().content[0].label == "ads"


def test_tokens_by_plug_in_and_mean_time(spark):
    df = spark.createDataFrame([("a b c",), (None,)], "text string")
    assert [r.n for r in df.select(B.tokens_counted(F.col("text"), lambda: lambda t: len(t.split())).alias("n")).collect()] == [3, None]
    run = spark.createDataFrame([(2, 3.0), (4, 9.0)], "docs int, seconds double")
    assert B.mean_time(run, "docs", "seconds").first().seconds_per_document == 2.0 and B.mean_time(run.limit(0), "docs", "seconds").first().seconds_per_document is None


def test_no_machine_local_folder_on_a_cluster():
    class Folder:
        isEmpty = staticmethod(lambda: True)

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": staticmethod(lambda: type("C", (), {"getCheckpointDir": staticmethod(lambda: Folder)}))})

    class Session:
        sparkContext = Context
        conf = type("F", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(RuntimeError):
        session.shared_folder(Session)
