"""Filters by label, by score and by language; document predicates around them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import canonical
from ..functions.lines import argmax, split_lines
from ..schema import CLEAN, LABELS
from .mask import check_mode, mask
from .scoring import LineModel, annotate_by_model

PARALLEL = ["line_quality_labels", "quality_scores"]


def by_label(df: DataFrame, remove: list[str], mode: str = "filter", split: Callable[[Column], Column] = split_lines, strict: bool = False) -> DataFrame:
    """Drops (or trims) lines whose label is in ``remove``; a line without label stays. Documents left empty are dropped."""
    if unknown := set(remove) - set(LABELS):
        raise ValueError(f"not a quality label: {sorted(unknown)}")
    return mask(df, PARALLEL, lambda z: ~F.coalesce(canonical(z["line_quality_labels"]).isin(remove), F.lit(False)), mode, split=split, strict=strict, leave=filled)


def filled(text: Column) -> Column:
    return text != ""


def at_least(score: Column, threshold: float) -> Column:
    """Null and NaN reach no threshold."""
    return ~F.isnan(score) & (score >= F.lit(threshold))


def by_score(df: DataFrame, threshold: float, mode: str = "filter", scores: str = "quality_scores", compat: bool = False) -> DataFrame:
    """Keeps (or trims to) lines scoring at least ``threshold``. Lines beyond the score list, and scores beyond the lines, go.

    ``compat``: the scores that come out are filtered over the whole list in either mode, so that with trim their number may differ
    from the lines'. Documents left empty are dropped.
    """
    check_mode(mode)
    if not compat:
        return mask(df, [scores], lambda z: at_least(z[scores], threshold), mode, leave=filled)
    out = mask(df.withColumn("__all", F.col(scores)), [scores], lambda z: at_least(z[scores], threshold), mode, leave=filled)
    return out.withColumn(scores, F.filter(F.col("__all"), lambda s: at_least(s, threshold))).drop("__all")


def worth_salvaging(df: DataFrame, below: float = 5.0, min_length: int = 250) -> DataFrame:
    """Documents whose first score is under ``below`` and whose text is long enough; no score means no salvage."""
    return df.where((F.get("doc_scores", F.lit(0)) < below) & (F.length("text") >= min_length))


def salvage(df: DataFrame, mode: str = "filter", min_length: int = 250, min_score: float = 0.9, below: float = 5.0, compat: bool = False) -> DataFrame:
    """Good lines of weak documents: Clean, scored over ``min_score`` and (filter only) in the document's language.

    Row-local predicates, robots.txt included, stand before the mask so that they reach the scan. ``compat``: trim leaves ``langs`` whole.
    """
    weak = worth_salvaging(df.where(F.col("robotstxt") == "allowed"), below, min_length)
    long = lambda text: F.length(text) >= min_length
    clean = lambda z: canonical(z["line_quality_labels"]) == CLEAN
    if check_mode(mode) == "filter":
        arrays = [*PARALLEL, "langs", "__lang"]
        spread = weak.withColumn("__lang", F.array_repeat("document_lang", F.size(split_lines(F.col("text")))))
        return mask(spread, arrays, lambda z: clean(z) & ~F.isnan(z["quality_scores"]) & (z["quality_scores"] > min_score) & (z["langs"] == z["__lang"]), mode, leave=long).drop("__lang")
    return mask(weak, [*PARALLEL, *([] if compat else ["langs"])], clean, mode, leave=long)


def salvage_classified(df: DataFrame, make: Callable[[], LineModel], mode: str = "filter", min_length: int = 250, below: float = 5.0, **limits: float) -> DataFrame:
    """``salvage`` of documents whose lines a plug-in model labels and scores on the way; what no label can save is dropped before the model."""
    weak = worth_salvaging(df.where(F.col("robotstxt") == "allowed"), below, min_length)
    return salvage(annotate_by_model(weak, make), mode, min_length, below=below, **limits)


def long_enough(df: DataFrame, min_length: int = 250) -> DataFrame:
    return df.where(F.length("text") >= min_length)


def allowed(df: DataFrame) -> DataFrame:
    return df.where((F.col("text") != "") & (F.col("robotstxt") == "allowed"))


def to_annotated(raw: DataFrame) -> DataFrame:
    """The output columns of annotation from a raw record; the language is the one of highest probability, the first of equals."""
    return raw.select(
        "text", "id", F.col("seg_langs").alias("langs"), "robotstxt", "collection", F.col("u").alias("url"),
        argmax(F.col("lang"), F.col("prob")).alias("document_lang"), "doc_scores",
    )
