import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.operators import analysis as A
from loomline.operators import sampling as P
from loomline.operators import scoring as R
from loomline.operators import synonyms as S
from loomline.operators import training as T
from loomline.operators.numbering import part_ceil, part_even, positional_slice, with_row_number
from loomline.sources.writers import split_rows


def test_bucket_borders(spark):
    df = spark.createDataFrame([(2, 3), (1, 3), (1, 2), (0, 4), (None, None)], "c long, n long")
    assert [r[0] for r in df.select(A.bucket(F.col("c"), F.col("n"))).collect()] == ["Clean", "Non-Clean", "Mixed", "Non-Clean", None]


def test_metrics_of_odd_arrays(spark):
    rows = [("a", [0.5, None, float("nan"), 7.0, 0.1], ["Clean", None, "x"], [3.0]), ("b", None, None, None), ("c", [], [], [])]
    got = A.doc_metrics(spark.createDataFrame(rows, "id string, quality_scores array<double>, line_quality_labels array<string>, doc_scores array<double>"), ["id"]).collect()
    assert (got[0].mean_line_score, got[0].median_line_score, got[0].min_line_score, got[0].clean_fraction) == (0.3, 0.3, 0.1, 0.5)
    assert got[1].mean_line_score is None and got[2].clean_fraction is None


def test_correlation_and_p(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=30)
    y = 0.4 * x + rng.normal(size=30)
    df = spark.createDataFrame([(float(a), float(b), 1.0) for a, b in zip(x, y, strict=True)], "x double, y double, c double")
    got = {r.metric: r for r in A.correlation_with_p(df, "x", ["y", "c"]).collect()}
    r = float(np.corrcoef(x, y)[0, 1])
    assert abs(got["y"].r - r) < 1e-9 and got["c"].r is None and got["c"].p is None
    # two-sided p by numerical integration of the t density
    df_, t = 28, abs(r) * math.sqrt(28 / (1 - r * r))
    grid = np.linspace(t, t + 400, 2_000_001)
    density = math.gamma((df_ + 1) / 2) / (math.sqrt(df_ * math.pi) * math.gamma(df_ / 2)) * (1 + grid**2 / df_) ** (-(df_ + 1) / 2)
    assert abs(got["y"].p - 2 * np.trapezoid(density, grid)) < 1e-6
    assert A.p_value(0.5, 2) is None and A.p_value(1.0, 5) == 0.0


def test_report_equals_plain_count(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 4, (200, 2))] + [(9, 0)]
    got = A.classification_metrics(spark.createDataFrame(pairs, "truth int, guess int")).first()
    labels = {a for p in pairs for a in p}
    f1s, supports = [], []
    for k in labels:
        hit = sum(a == b == k for a, b in pairs)
        s, g = sum(a == k for a, _ in pairs), sum(b == k for _, b in pairs)
        f1s.append(2 * hit / (s + g) if hit else 0)
        supports.append(s)
    assert abs(got.macro_f1 - np.mean(f1s)) < 1e-12 and abs(got.weighted_f1 - np.average(f1s, weights=supports)) < 1e-12
    assert abs(got.accuracy - np.mean([a == b for a, b in pairs])) < 1e-12
    assert A.classification_metrics(spark.createDataFrame([], "truth int, guess int")).first().n is None


def test_row_numbers_and_parts(spark):
    df = spark.range(0, 97).repartition(5)
    assert sorted((r.id, r.row_no) for r in with_row_number(df, "id").collect()) == [(i, i) for i in range(97)]
    assert with_row_number(spark.range(0), "id").count() == 0
    assert [r.id for r in positional_slice(df, 3, 6, "id").orderBy("id").collect()] == [3, 4, 5]
    assert positional_slice(df, 90, -1, "id").count() == 7
    for n in range(1, 40):
        for k in range(1, 15):
            rows = spark  # formulas are checked through the driver's arithmetic below
            q, r = divmod(n, k)
            want = [i for i in range(k) for _ in range(q + (i < r))]
            got = [i // (q + 1) if i < r * (q + 1) else r + (i - r * (q + 1)) // max(q, 1) for i in range(n)]
            assert rows is spark and got == want
    parts = [r.part for r in split_rows(df, 7, "id").orderBy("id").collect()]
    assert [parts.count(i) for i in range(7)] == [14] * 6 + [13]
    few = {r.part for r in split_rows(spark.range(0, 3), 7, "id").collect()}
    assert few == {0, 1, 2}
    assert spark.range(10).select(part_ceil(F.col("id"), 10, 4).alias("p")).groupBy("p").count().count() == 4
    assert spark.range(1).select(part_even(F.col("id"), 1, 4)).first()[0] == 0


def test_sampling(spark):
    df = spark.createDataFrame([(str(i),) for i in range(50)] + [(None,), ("1",)], "id string")
    ids = P.sample_ids(df, 10)
    assert ids.count() == 10 and sorted(r.id for r in ids.collect()) == sorted(r.id for r in P.sample_ids(df, 10).collect())
    assert P.restrict(df, ids).count() in (10, 11) and P.remaining(df, ids).count() in (41, 42)
    assert sum(P.shard(df.where("id is not null"), i, 5).count() for i in range(5)) == 51
    got = P.check_same_ids(df, ids).first()
    assert (got.matched, got.right_only) == (10, 0)


def test_training_sets(spark):
    rows = [(f"t{i}", "Clean") for i in range(100)] + [("j1", "Spam"), ("j2", "Spam"), ("k", "Other"), ("n", None)]
    df = spark.createDataFrame(rows, "text string, label string")
    down = T.downsample(df, 0.2)
    assert down.where("label = 'Clean'").count() == 20 and down.count() == 24
    split = T.stratified_split(df)
    got = {(r.label, r.split): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert got[("Clean", "train")] == 70 and got[("Clean", "validation")] == 15 and got[("Clean", "test")] == 15 and got[("Other", "train")] == 1
    assert {r.label: r.code for r in T.label_map(df).collect()} == {"Clean": 0, "Other": 1, "Spam": 2}
    weights = {r.label: r.weight for r in A.class_weights(df.where("label is not null")).collect()}
    assert abs(weights["Clean"] - 103 / (3 * 100)) < 1e-12
    with pytest.raises(ValueError):
        T.downsample(df, 0)


def test_model_scorer_runs_once(spark):
    df = spark.createDataFrame([("1", "Hello there my friend, welcome.\nshort"), ("2", None), ("3", "")], "id string, text string")
    scored = R.annotate_by_model(df, R.rule_model).where(F.size("line_quality_labels") > 0)
    assert str(scored._jdf.queryExecution().executedPlan().toString()).count("ArrowEvalPython") == 1
    rules = {r.id: r for r in R.annotate_by_rules(df).collect()}
    for r in scored.collect():
        assert r.line_quality_labels == rules[r.id].line_quality_labels
    labelled = R.annotate_documents(df, lambda: lambda texts: [[len(t), 5] for t in texts], ["long", "short"]).orderBy("id").collect()
    assert [r.doc_label for r in labelled] == ["long", None, "short"]


def plain_linkage(v, threshold):
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    d = 1 - u @ u.T
    groups = [[i] for i in range(len(v))]
    while len(groups) > 1:
        best = min(((np.mean([d[i, j] for i in a for j in b]), x, y) for x, a in enumerate(groups) for y, b in enumerate(groups) if x < y), key=lambda t: t[0])
        if best[0] >= threshold:
            break
        groups[best[1]] += groups.pop(best[2])
    return {frozenset(g) for g in groups}


def test_linkage_and_medoids(spark):
    rng = np.random.default_rng(4)
    for _ in range(10):
        v = rng.normal(size=(14, 3))
        got = S.average_linkage(v, 0.4)
        assert {frozenset(np.flatnonzero(got == k).tolist()) for k in set(got)} == plain_linkage(v, 0.4)
    v = rng.normal(size=(12, 4))
    df = spark.createDataFrame([(0, i, [float(x) for x in row]) for i, row in enumerate(v)] + [(1, 99, [0.0] * 4)], "g int, k int, embedding array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    sums = (1 - u @ u.T).sum(axis=1)
    got = S.medoids(df, "g", "k").collect()
    assert len(got) == 1 and got[0].k == int(sums.argmin()) and abs(got[0].sum_distance - sums.min()) < 1e-5
    assert S.average_linkage(np.zeros((0, 3)), 0.2).tolist() == []
    vocab = spark.createDataFrame([("navigation menu", 3), ("Navigation menu", 2), ("cookie notice", 1), (None, 1)], "label string, n long")
    names = {r.label: r.name for r in S.synonym_map(vocab, 0.3).collect()}
    assert set(names) == {"navigation menu", "Navigation menu"} and len(set(names.values())) == 1
