import random

import pytest
from pyspark.sql import functions as F

from loomline.operators import quality as Q
from loomline.operators.mask import mask
from loomline.schema import JUNK_LABELS, parse_labels

SCHEMA = "id string, text string, line_quality_labels array<string>, quality_scores array<double>, langs array<string>, document_lang string, doc_scores array<double>, robotstxt string, line string, pos int"
J = JUNK_LABELS[0]


def frame(spark, rows):
    full = [(str(i), t, q, s, g, "eng_Latn", d, r, "clash", 7) for i, (t, q, s, g, d, r) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def labelled(spark, *labels):
    rows = [("\n".join(f"l{i}" for i in range(len(q))) if q else t, q, [0.5] * len(q) if q else None, None, None, "allowed") for q, t in labels]
    return frame(spark, rows)


def test_filter_and_trim_by_label(spark):
    df = labelled(spark, (["Clean"] * 3, ""), ([J] * 3, ""), ([J, "Clean", J, "Clean", J], ""), (["Clean"], ""), (None, None), (None, ""))
    f = {r.id: r for r in Q.by_label(df, JUNK_LABELS).collect()}
    t = {r.id: r for r in Q.by_label(df, JUNK_LABELS, "trim").collect()}
    assert f["0"].text == "l0\nl1\nl2" and "1" not in f and f["2"].text == "l1\nl3" and f["2"].line_quality_labels == ["Clean", "Clean"]
    assert t["2"].text == "l1\nl2\nl3" and t["2"].quality_scores == [0.5] * 3 and "1" not in t and "4" not in t and "5" not in t
    assert f["0"].line == "clash" and f["0"].pos == 7


def test_lengths_that_differ(spark):
    rows = [("a\nb\nc", ["Clean", J], [0.9], None, None, None), ("a", ["Clean", "Clean"], [0.9, 0.1], None, None, None), ("a\nb", None, None, None, None, None)]
    got = [r.text for r in Q.by_label(frame(spark, rows), JUNK_LABELS).orderBy("id").collect()]
    assert got == ["a\nc", "a", "a\nb"]
    with pytest.raises(Exception, match="array length"):
        Q.by_label(frame(spark, rows), JUNK_LABELS, strict=True).collect()


def by_score(lines, scores, t, mode):
    ok = [s is not None and s == s and s >= t for s in scores]
    if mode == "filter":
        return [x for x, k in zip(lines, ok, strict=False) if k]
    at = [i for i, k in enumerate(ok) if k and i < len(lines)]
    return lines[at[0] : at[-1] + 1] if at else []


@pytest.mark.parametrize("mode", ["filter", "trim"])
def test_score_masks_equal_restatement(spark, mode):
    rng = random.Random(3)
    rows = []
    for _ in range(150):
        n = rng.randrange(1, 9)
        m = max(0, n + rng.choice([-2, 0, 0, 1]))
        rows.append(("\n".join(f"x{i}" for i in range(n)), None, [rng.choice([0.8, 0.79, 0.9, None, float("nan"), 0.1]) for _ in range(m)], None, None, None))
    got = {r.id: r for r in Q.by_score(frame(spark, rows), 0.8, mode).collect()}
    for i, (t, _, s, *_rest) in enumerate(rows):
        want = "\n".join(by_score(t.split("\n"), s, 0.8, mode))
        assert (got[str(i)].text if str(i) in got else "") == want


def test_compat_scores(spark):
    df = frame(spark, [("a\nb\nc", None, [0.9, 0.1, 0.9], None, None, None)])
    assert Q.by_score(df, 0.8, "trim").first().quality_scores == [0.9, 0.1, 0.9]
    assert Q.by_score(df, 0.8, "trim", compat=True).first().quality_scores == [0.9, 0.9]


def test_salvage_borders(spark):
    long = "x" * 300
    ok = (long + "\n" + long, ["Clean", "Clean"], [0.9, 0.91], ["eng_Latn"] * 2, [4.99], "allowed")
    rows = [ok, (*ok[:4], [5.0], "allowed"), (*ok[:5], "disallowed"), (*ok[:4], [], "allowed"), (*ok[:3], ["eng_Latn", "fin_Latn"], [1.0], "allowed"), ("y" * 249, ["Clean"], [1.0], ["eng_Latn"], [1.0], "allowed")]
    got = Q.salvage(frame(spark, rows)).collect()
    assert [(r.id, r.text) for r in got] == [("0", long)]
    trimmed = Q.salvage(frame(spark, rows), "trim", compat=True).orderBy("id").collect()
    assert [r.id for r in trimmed] == ["0", "4"] and trimmed[0].langs == ["eng_Latn"] * 2


def test_one_scan_no_shuffle(spark):
    df = Q.by_label(frame(spark, [("a", ["Clean"], [1.0], None, None, None)]), JUNK_LABELS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_idempotent_and_nested(spark):
    rng = random.Random(5)
    rows = [("\n".join(f"w{i}" for i in range(n)), [rng.choice(["Clean", J]) for _ in range(n)], None, None, None, None) for n in [rng.randrange(1, 12) for _ in range(60)]]
    df = frame(spark, rows)
    f, t = Q.by_label(df, JUNK_LABELS), Q.by_label(df, JUNK_LABELS, "trim")
    assert sorted(map(str, Q.by_label(f, JUNK_LABELS).collect())) == sorted(map(str, f.collect()))
    assert sorted(map(str, Q.by_label(t, JUNK_LABELS, "trim").collect())) == sorted(map(str, t.collect()))
    kept = {r.id: set(r.text.split("\n")) for r in f.collect()}
    trimmed = {r.id: set(r.text.split("\n")) for r in t.collect()}
    assert kept.keys() == trimmed.keys() and all(kept[k] <= trimmed[k] for k in kept)


def test_arguments(spark):
    with pytest.raises(ValueError):
        Q.by_label(frame(spark, []), JUNK_LABELS, "both")
    with pytest.raises(ValueError):
        parse_labels("clean,nonsense")
    assert parse_labels("all") == JUNK_LABELS and parse_labels("spam, toxic") == ["Promotional & Spam Content", "Offensive or Inappropriate Content"]
    assert mask(frame(spark, []), [], lambda z: F.lit(True)).count() == 0
