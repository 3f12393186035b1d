import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.functions import lines as L
from loomline.functions.labels import canonical, language_name, repaired

TEXTS = ["a\n", "", "\n", "a\x0bb c\r\nd", "x\n\ny\n\n", "a\x1cb c\x85d", "a\x1fb", "é b\rc", None]


def one(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_splits_equal_python(spark):
    got = one(spark, TEXTS, L.split_lines(F.col("t")), L.split_universal(F.col("t")), L.split_stripped(F.col("t")))
    for text, (a, b, c) in zip(TEXTS, got, strict=True):
        assert a == (None if text is None else text.split("\n"))
        assert b == (None if text is None else text.splitlines())
        assert c == (None if text is None else text.strip().split("\n"))


def batches(n, size):
    k = math.ceil(n / size)
    short, longer = divmod(n, k) if k else (0, 0)
    return [short + (i < longer) for i in range(k)]


def test_even_batches(spark):
    sizes = [1, 9, 10, 11, 25, 99]
    df = spark.createDataFrame([(n, [str(i) for i in range(n)]) for n in sizes], "n int, a array<string>")
    for row in df.select("n", "a", L.even_batches(F.col("a"), 10).alias("b")).collect():
        assert [len(x) for x in row.b] == batches(row.n, 10)
        assert [y for x in row.b for y in x] == row.a
    assert spark.createDataFrame([([],)], "a array<string>").select(L.even_batches(F.col("a"), 10)).first()[0] == []
    assert spark.createDataFrame([(None,)], "a array<string>").select(L.even_batches(F.col("a"), 10)).first()[0] is None


def packed(text, limit=200):
    import re

    out, now = [], ""
    for s in re.split(r"(?<=[.!?])\s+", text):
        if len(now) + len(s) + 1 > limit:
            out.append(now.strip())
            now = s
        else:
            now += " " + s
    return out + ([now.strip()] if now else [])


def test_segments(spark):
    rng = random.Random(1)
    texts = ["", "a. ", "x" * 250 + ". b", "no terminator", "a. b! c? d"]
    texts += [" ".join("w" * rng.randrange(1, 90) + rng.choice(".!?,") for _ in range(rng.randrange(1, 14))) for _ in range(40)]
    for text, (got,) in zip(texts, one(spark, texts, L.segments(F.col("t"))), strict=True):
        assert got == packed(text)


def test_argmax_first_of_equals(spark):
    df = spark.createDataFrame([(["a", "b"], [0.5, 0.5]), (["a"], [0.1]), ([], []), (None, None), (["a", "b"], [0.1, float("nan")])], "l array<string>, p array<double>")
    assert [r[0] for r in df.select(L.argmax(F.col("l"), F.col("p"))).collect()] == ["a", "a", None, None, "b"]


def test_score_list(spark):
    texts = ["[0.1, 0.2]", "(0.1, 0.2)", "(0.5,)", "(0.757)", " [1]\n", "[0.1, None]", "[]", "[0.1", "x", None, "[0.1, abc]"]
    want = [[0.1, 0.2], [0.1, 0.2], [0.5], [0.757], [1.0], [0.1, None], [], None, None, None, None]
    assert [x for (x,) in one(spark, texts, L.score_list(F.col("t")))] == want


def test_model_text_and_check(spark):
    texts = ["```json\n{\"a\": 1}\n```", "nojson x", "Line 1: Clean\nLine 29: x", "Line 30: x", "Line 1:", "label: Spam : x"]
    got = one(spark, texts, L.model_text(F.col("t")), L.well_formed(F.col("t")), L.label_after_colon(F.col("t")))
    assert [g[0] for g in got[:2]] == ['{"a": 1}', "x"]
    assert [g[1] for g in got[2:5]] == [True, False, False]
    assert got[5][2] == "spam"


def test_labels(spark):
    texts = [" clean ", "CLEAN", "Spam", None, "promotional & spam content"]
    got = one(spark, texts, canonical(F.col("t")), repaired(F.col("t")))
    assert got == [("Clean", "Clean"), ("Clean", "Clean"), ("Spam", "Clean"), (None, "Clean"), ("Promotional & Spam Content",) * 2]
    codes = one(spark, ["fin_Latn", "lvs_Latn", "xxx", None], language_name(F.col("t"), strict=False))
    assert codes == [("Finnish",), ("Latvian",), (None,), (None,)]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=8))
def test_batch_sizes_differ_by_one(sizes):
    for n in sizes:
        got = batches(n, 10)
        assert sum(got) == n and max(got) - min(got) <= 1
