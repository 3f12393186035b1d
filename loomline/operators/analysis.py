"""Document-versus-line statistics, label counts, classifier metrics. Everything aggregates on the map side first."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import canonical
from ..schema import CLEAN, LABELS
from ..session import broadcast_if_small
from .numbering import with_row_number

BUCKETS = ["Clean", "Mixed", "Non-Clean"]


def label_frequency(df: DataFrame, labels: str = "line_quality_labels") -> DataFrame:
    return df.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def clean_share(df: DataFrame, labels: str = "line_quality_labels") -> DataFrame:
    """Number of labelled lines and the share of clean ones (null without lines)."""
    lines = df.select(F.explode(labels).alias("label")).where(F.col("label").isNotNull())
    return lines.agg(F.count("*").alias("n_lines"), F.avg((canonical(F.col("label")) == CLEAN).cast("double")).alias("clean_share"))


def usable(scores: Column) -> Column:
    """Scores without nulls, NaN and values outside 0..1."""
    return F.filter(scores, lambda s: s.isNotNull() & ~F.isnan(s) & s.between(0, 1))


def doc_metrics(df: DataFrame, key: list[str], scores: str = "quality_scores", labels: str = "line_quality_labels", doc_scores: str = "doc_scores") -> DataFrame:
    """Document score beside mean, median and least line score and the clean fraction; null where nothing can be measured.

    Computed on the arrays, without exploding or shuffling.
    """
    s = F.sort_array(usable(F.col(scores)))
    n = F.size(s)
    middle = (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2
    known = F.filter(F.col(labels), lambda x: x.isNotNull())
    clean = F.size(F.filter(known, lambda x: canonical(x) == CLEAN))
    return df.select(
        *key,
        F.get(doc_scores, F.lit(0)).alias("doc_score"),
        F.when(n > 0, F.aggregate(s, F.lit(0.0), lambda a, x: a + x) / n).alias("mean_line_score"),
        F.when(n > 0, middle).alias("median_line_score"),
        F.when(n > 0, F.get(s, F.lit(0))).alias("min_line_score"),
        F.when(F.size(known) > 0, clean / F.size(known)).alias("clean_fraction"),
        F.when(F.size(known) > 0, clean.cast("bigint")).alias("n_clean"),
        F.when(F.size(known) > 0, F.size(known).cast("bigint")).alias("n_lines"),
    )


def bucket(n_clean: Column, n_lines: Column) -> Column:
    """Clean from two thirds on, Mixed over one third, else Non-Clean; in integers, so that the borders are exact."""
    return F.when(3 * n_clean >= 2 * n_lines, BUCKETS[0]).when(3 * n_clean > n_lines, BUCKETS[1]).when(n_lines.isNotNull(), BUCKETS[2])


def crosstab(df: DataFrame, row: str, column: str, columns: list[str], rows: list[str] | None = None) -> DataFrame:
    """Counts with fixed columns, and fixed rows where given; absent combinations count 0."""
    out = df.groupBy(row).pivot(column, columns).count()
    if rows is not None:
        frame = df.sparkSession.createDataFrame([(r,) for r in rows], f"{row} string")
        out = frame.join(out, row, "left")
    return out.na.fill(0, columns)


def correlation(df: DataFrame, target: str, metrics: list[str]) -> DataFrame:
    """Pearson r of each metric with ``target`` over the rows where both are present: metric, n, r. r is null where either is constant."""
    sums = []
    for i, m in enumerate(metrics):
        both = F.col(target).isNotNull() & F.col(m).isNotNull()
        x, y = F.when(both, F.col(target)), F.when(both, F.col(m))
        sums += [F.count(F.when(both, 1)).alias(f"n{i}"), F.covar_pop(x, y).alias(f"c{i}"), F.stddev_pop(x).alias(f"x{i}"), F.stddev_pop(y).alias(f"y{i}")]
    one = df.agg(*sums)
    rows = F.array(
        *(
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"n{i}").alias("n"),
                F.when((F.col(f"x{i}") > 0) & (F.col(f"y{i}") > 0), F.col(f"c{i}") / (F.col(f"x{i}") * F.col(f"y{i}"))).alias("r"),
            )
            for i, m in enumerate(metrics)
        )
    )
    return one.select(F.inline(rows))


def p_value(r: float | None, n: int) -> float | None:
    """Two-sided p of a Pearson r, by the t statistic with n - 2 degrees of freedom."""
    if r is None or n < 3:
        return None
    if abs(r) >= 1:
        return 0.0
    df = n - 2
    return incomplete_beta(df / 2, 0.5, df / (df + r * r * df / (1 - r * r)))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction (modified Lentz)."""
    if x in (0.0, 1.0):
        return x
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    f, c, d = 1.0, 1.0, 0.0
    for k in range(500):
        m = k // 2
        if k == 0:
            t = 1.0
        elif k % 2 == 0:
            t = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            t = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / ((1 + t * d) or tiny)
        c = (1 + t / c) or tiny
        f *= c * d
        if abs(1 - c * d) < 1e-15:
            break
    return front * (f - 1)


def correlation_with_p(df: DataFrame, target: str, metrics: list[str]) -> DataFrame:
    """``correlation`` with the p-value added; one row per metric goes through the driver."""
    rows = [(r["metric"], r["n"], r["r"], p_value(r["r"], r["n"])) for r in correlation(df, target, metrics).collect()]
    return df.sparkSession.createDataFrame(rows, "metric string, n bigint, r double, p double")


def box_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Box-plot figures by category: quartiles, between neighbours where they fall so, and the outermost values within 1.5 interquartile ranges.

    Exact from one range sort of (category, value): quartiles are looked up by position, so that a category with most rows is no hot group.
    Null values and categories are left out.
    """
    present = df.where(F.col(value).isNotNull() & F.col(by).isNotNull()).select(by, value)
    numbered = with_row_number(present, by, value)
    groups = numbered.groupBy(by).agg(F.count("*").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"), F.min("row_no").alias("__from"))
    parts = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    at = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), ((F.col("n") - 1) * F.lit(q)).alias("at")) for name, q in parts.items()))).alias("w")
    wanted = groups.select(F.col(by).alias("__by"), "__from", at).select("__by", "w.name", F.col("w.at").alias("at"), F.explode(F.array(F.floor("w.at"), F.ceil("w.at"))).alias("side"), "__from")
    wanted = broadcast_if_small(wanted.select("__by", "name", "at", (F.col("__from") + F.col("side")).alias("__row")).distinct())
    found = numbered.join(wanted, (F.col("row_no") == F.col("__row")) & (F.col(by) == F.col("__by")))
    low, high = F.min(value), F.max(value)
    quartile = found.groupBy(by, "name").agg((low + (high - low) * (F.first("at") - F.floor(F.first("at")))).alias("x"))
    q = groups.drop("__from").join(quartile.groupBy(by).pivot("name", list(parts)).agg(F.first("x")), by)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = present.join(broadcast_if_small(q.select(by, "q1", "q3")), by)
    whiskers = inside.groupBy(by).agg(
        F.min(F.when(F.col(value) >= F.col("q1") - reach, F.col(value))).alias("low_whisker"),
        F.max(F.when(F.col(value) <= F.col("q3") + reach, F.col(value))).alias("high_whisker"),
    )
    return q.join(whiskers, by)


def regression(df: DataFrame, x: str, y: str) -> DataFrame:
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.agg(F.count("*").alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def confusion(df: DataFrame, truth: str = "truth", guess: str = "guess") -> DataFrame:
    return df.where(F.col(truth).isNotNull() & F.col(guess).isNotNull()).groupBy(truth, guess).agg(F.count("*").alias("n"))


def class_report(matrix: DataFrame, truth: str = "truth", guess: str = "guess") -> DataFrame:
    """Precision, recall and F1 per class from a confusion matrix; a zero division gives 0."""
    ratio = lambda a, b: F.when(b > 0, a / F.greatest(b, F.lit(1))).otherwise(0.0)
    sides = matrix.select(F.col(truth).alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"), F.when(F.col(truth) == F.col(guess), F.col("n")).otherwise(0).alias("hit"))
    sides = sides.unionByName(matrix.select(F.col(guess).alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hit")))
    per = sides.groupBy("label").agg(*(F.sum(c).alias(c) for c in ("support", "guessed", "hit")))
    per = per.withColumns({"precision": ratio(F.col("hit"), F.col("guessed")), "recall": ratio(F.col("hit"), F.col("support"))})
    return per.withColumn("f1", F.when(F.col("hit") > 0, 2.0 * F.col("hit") / (F.col("support") + F.col("guessed"))).otherwise(0.0))


def classification_metrics(df: DataFrame, truth: str = "truth", guess: str = "guess") -> DataFrame:
    """Accuracy, weighted, micro and macro F1, weighted precision and recall: one row."""
    per = class_report(confusion(df, truth, guess), truth, guess)
    n = F.sum("support")
    weighted = lambda c: F.when(n > 0, F.sum(F.col(c) * F.col("support")) / F.greatest(n, F.lit(1))).alias(f"weighted_{c}")
    accuracy = F.when(n > 0, F.sum("hit") / F.greatest(n, F.lit(1)))
    return per.agg(n.alias("n"), accuracy.alias("accuracy"), accuracy.alias("micro_f1"), F.avg("f1").alias("macro_f1"), weighted("f1"), weighted("precision"), weighted("recall"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights: n / (classes x rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"), F.count("*").alias("classes"))
    return counts.crossJoin(F.broadcast(total)).select(label, "n", (F.col("total") / (F.col("classes") * F.col("n"))).alias("weight"))


def label_order() -> list[str]:
    return [CLEAN, *sorted(x for x in LABELS if x != CLEAN)]
