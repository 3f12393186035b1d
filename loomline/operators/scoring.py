"""Line scorers: a rule scorer in Catalyst, and a plug-in scorer that runs any model in Arrow batches.

A plug-in is made once per Python worker and sees micro-batches of lines sorted by length; it is marked non-deterministic so that
Catalyst evaluates it once, hence cheap predicates belong before it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lines import split_lines
from ..schema import SHORTHANDS

#: Rules in order, the first match wins; written so that Java and RE2 agree.
RULES = [
    (r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", "contact"),
    (r"(?i)copyright|license|all rights", "legal"),
    (r"(?i)click here|subscribe|buy now", "spam"),
    (r"(?i)https?://|<[a-z/]|(token|key|secret) = ", "tech"),
    (r"[#$%&*]{3}", "errors"),
]
SHORT = 20

#: (lines) -> (labels, probabilities of Clean)
LineModel = Callable[[list[str]], tuple[list[str], list[float]]]


def rule_label(line: Column) -> Column:
    out = F.when(F.length(line) < SHORT, SHORTHANDS["interface"]).otherwise(SHORTHANDS["clean"])
    for pattern, short in reversed(RULES):
        out = F.when(line.rlike(pattern), SHORTHANDS[short]).otherwise(out)
    return out


def rule_score(line: Column) -> Column:
    """Share of ASCII letters."""
    return F.round(F.length(F.regexp_replace(line, "[^A-Za-z]", "")) / F.greatest(F.length(line), F.lit(1)), 3)


def annotate_by_rules(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds line_quality_labels and quality_scores; null text gives null arrays."""
    lines = split_lines(F.col(text))
    return df.withColumns({"line_quality_labels": F.transform(lines, rule_label), "quality_scores": F.transform(lines, rule_score)})


def annotate_by_model(df: DataFrame, make: Callable[[], LineModel], batch: int = 128, text: str = "text") -> DataFrame:
    """Adds line_quality_labels and quality_scores of a plug-in model, the score rounded to 3 places as binary value, half to even."""

    def classify(series: pd.Series, model: LineModel) -> pd.DataFrame:
        pages = [None if x is None else x.split("\n") for x in series]
        flat = [line for page in pages if page is not None for line in page]
        labels, scores = [""] * len(flat), np.zeros(len(flat))
        order = np.argsort([len(x) for x in flat], kind="stable")
        for start in range(0, len(order), batch):
            at = order[start : start + batch]
            got, clean = model([flat[i] for i in at])
            for i, label, score in zip(at, got, clean, strict=True):
                labels[i], scores[i] = label, round(float(score), 3)
        out, k = [], 0
        for page in pages:
            n = 0 if page is None else len(page)
            out.append((None, None) if page is None else (labels[k : k + n], scores[k : k + n].tolist()))
            k += n
        return pd.DataFrame(out, columns=["labels", "scores"])

    @F.pandas_udf("labels array<string>, scores array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make()
        for series in batches:
            yield classify(series, model)

    scored = df.withColumn("__scored", run.asNondeterministic()(F.col(text)))
    return scored.withColumns({"line_quality_labels": F.col("__scored.labels"), "quality_scores": F.col("__scored.scores")}).drop("__scored")


def annotate_documents(df: DataFrame, make: Callable[[], Callable[[list[str]], list[list[float]]]], classes: list[str], text: str = "text", batch: int = 64) -> DataFrame:
    """Adds doc_label, the class of highest logit of a document-level plug-in model (the first of equals); null text gives null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for series in batches:
            out = pd.Series([None] * len(series), dtype=object)
            at = np.flatnonzero(series.notna().to_numpy())
            for start in range(0, len(at), batch):
                part = at[start : start + batch]
                for i, logits in zip(part, model([series.iloc[j] for j in part]), strict=True):
                    out.iloc[i] = classes[int(np.argmax(logits))]
            yield out

    return df.withColumn("doc_label", run.asNondeterministic()(F.col(text)))


def rule_model() -> LineModel:
    """The rules as a plug-in, for tests of the plug-in path."""
    import re

    compiled = [(re.compile(p), SHORTHANDS[s]) for p, s in RULES]

    def label(line: str) -> str:
        return next((s for p, s in compiled if p.search(line)), SHORTHANDS["interface"] if len(line) < SHORT else SHORTHANDS["clean"])

    def score(line: str) -> float:
        return sum("a" <= c <= "z" or "A" <= c <= "Z" for c in line) / max(1, len(line))

    return lambda lines: ([label(x) for x in lines], [score(x) for x in lines])
