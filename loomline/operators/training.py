"""Training sets for line classifiers: flatten, repair, downsample, split, encode; and a trainable scorer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import repaired
from ..schema import CLEAN
from ..session import broadcast_if_small, checkpointed
from .numbering import with_row_number


def flatten(results: DataFrame, content: str = "content") -> DataFrame:
    """(text, label) of every labelled line, invalid labels repaired to Clean; null lines are left out."""
    lines = results.select(F.explode(content).alias("c"))
    return lines.where(F.col("c.line").isNotNull()).select(F.col("c.line").alias("text"), repaired(F.col("c.label")).alias("label"))


def hash_order(*key: str) -> list[Column]:
    """An order that looks random and never changes: by md5 of the key, then the key."""
    return [F.md5(F.concat_ws("\x01", *(F.coalesce(F.col(k).cast("string"), F.lit("\x02")) for k in key))), *(F.col(k) for k in key)]


def downsample(df: DataFrame, fraction: float = 0.2, key: tuple[str, ...] = ("text",), label: str = "label", keep: str = CLEAN) -> DataFrame:
    """Exactly round(fraction x n) rows of class ``keep``, half to even, and all others; 1 leaves everything."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    if fraction == 1:
        return df
    clean = df.where(F.col(label) == keep)
    wanted = round(fraction * clean.count())
    drawn = with_row_number(clean, *hash_order(*key)).where(F.col("row_no") < wanted).drop("row_no")
    return drawn.unionByName(df.where(~F.coalesce(F.col(label) == keep, F.lit(False))))


def stratified_split(df: DataFrame, shares: tuple[int, int, int] = (70, 15, 15), key: tuple[str, ...] = ("text",), label: str = "label") -> DataFrame:
    """Adds ``split`` (train, validation, test) by per cent within each class; a class of one row goes to train.

    Ranks come from one global range sort less the offset of the class, so that a class holding most rows is no hot partition.
    """
    if sum(shares) != 100 or min(shares) < 0:
        raise ValueError("shares must be three per cents that add up to 100")
    numbered = with_row_number(df, F.col(label), *hash_order(*key))
    classes = broadcast_if_small(numbered.groupBy(F.col(label).alias("__label")).agg(F.min("row_no").alias("__from"), F.count("*").alias("__n")))
    rank = F.col("row_no") - F.col("__from")
    split = F.when(rank * 100 < F.col("__n") * shares[0], "train").when(rank * 100 < F.col("__n") * (shares[0] + shares[1]), "validation").otherwise("test")
    return numbered.join(classes, F.col(label).eqNullSafe(F.col("__label"))).withColumn("split", split).drop("row_no", "__label", "__from", "__n")


def label_map(df: DataFrame, label: str = "label") -> DataFrame:
    """Integer codes: Clean 0, the others alphabetically after it. Bounded by the number of classes."""
    from pyspark.sql import Window

    distinct = df.where(F.col(label).isNotNull()).select(label).distinct()
    return distinct.withColumn("code", F.row_number().over(Window.orderBy(F.col(label) != CLEAN, label)) - 1)


def encode(df: DataFrame, label: str = "label") -> DataFrame:
    return df.join(broadcast_if_small(label_map(df, label)), label, "left")


def line_classifier(train: DataFrame, weights: DataFrame | None = None, features: int = 1 << 16, iterations: int = 20) -> PipelineModel:
    """A trainable line scorer on text and code: hashed character pieces and logistic regression, classes weighted where given."""
    if weights is not None:
        train = train.join(broadcast_if_small(weights.select("label", "weight")), "label", "left")
    tokens = RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"(?U)\w+|[^\w\s]+", gaps=False)
    hashed = HashingTF(inputCol="tokens", outputCol="features", numFeatures=features)
    model = LogisticRegression(labelCol="code", maxIter=iterations, **({"weightCol": "weight"} if weights is not None else {}))
    return Pipeline(stages=[tokens, hashed, model]).fit(train)


@dataclass
class Classifier:
    """A softmax model over hashed features, with the losses met at each evaluation."""

    weights: np.ndarray
    history: list[tuple[int, float]] = field(default_factory=list)

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` of (text, ...) with ``guess``, the code of the class of highest weight, the first of equals."""
        shared = df.sparkSession.sparkContext.broadcast(self.weights)

        @F.pandas_udf("int")
        def best(places: pd.Series) -> pd.Series:
            w = shared.value
            return pd.Series([int(w[np.asarray(p, dtype=int)].sum(axis=0).argmax()) for p in places], dtype="int32")

        return featured(df, len(self.weights)).withColumn("guess", best("v")).drop("v")


def featured(df: DataFrame, features: int) -> DataFrame:
    """Adds ``v``, places of the hashed pieces of ``text``, repeats kept."""
    pieces = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"((?U)\w+|[^\w\s]+)"), F.lit(1))
    return df.withColumn("v", F.transform(pieces, lambda t: F.pmod(F.xxhash64(t), F.lit(features)).cast("int")))


def smoothed_loss(logits: np.ndarray, codes: np.ndarray, weights: np.ndarray, smoothing: float) -> tuple[np.ndarray, np.ndarray]:
    """(loss of each row, gradient by its logits): weighted cross entropy against labels of which ``smoothing`` is spread over all classes."""
    z = logits - logits.max(axis=1, keepdims=True)
    logs = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    target = np.full(logits.shape, smoothing / logits.shape[1])
    target[np.arange(len(codes)), codes] += 1 - smoothing
    target *= weights
    return -(target * logs).sum(axis=1), np.exp(logs) * target.sum(axis=1, keepdims=True) - target


def train_classifier(
    train: DataFrame, validation: DataFrame, classes: int, weights: dict[int, float] | None = None, smoothing: float = 0.1, features: int = 1 << 16,
    steps: int = 60, rate: float = 0.5, every: int = 5, patience: int = 3,
) -> Classifier:
    """Gradient steps over all rows of (text, code), with class weights and label smoothing.

    Every ``every`` steps the validation loss is taken; training ends when it did not improve ``patience`` times in a row, and the model of
    the least loss is given back. Tasks add up their gradients: what comes to the driver in a step is one number per used feature and class.
    Rows are hashed once, into the checkpoint folder. No rows give a model of zeros.
    """
    sets = [checkpointed(featured(x.select("text", F.col("code").cast("int").alias("code")).where(F.col("code").isNotNull()), features).select("v", "code")) for x in (train, validation)]
    by_class = np.array([(weights or {}).get(c, 1.0) for c in range(classes)])

    def losses(data: DataFrame, w: np.ndarray, gradient: bool) -> tuple[float, np.ndarray]:
        shared = data.sparkSession.sparkContext.broadcast(w)

        def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            w, total, grad, rows = shared.value, 0.0, np.zeros(shared.value.shape), 0.0
            for frame in frames:
                for places, code in zip(frame["v"], frame["code"], strict=True):
                    at, x = np.unique(np.asarray(places, dtype=int), return_counts=True)
                    loss, g = smoothed_loss((x @ w[at])[None], np.array([code]), by_class, smoothing)
                    total += float(loss[0])
                    rows += by_class[code]
                    if gradient:
                        grad[at] += x[:, None] * g
            cells = np.flatnonzero(grad)
            yield pd.DataFrame({"cell": np.r_[-1, -2, cells], "n": np.r_[total, rows, grad.ravel()[cells]]})

        got = data.mapInPandas(part, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        cell, n = got["cell"].to_numpy(dtype=np.int64), got["n"].to_numpy(dtype=float)
        rows = max(float(n[cell == -2].sum()), 1e-9)
        grad = np.zeros(w.size)
        grad[cell[cell >= 0]] = n[cell >= 0]
        return float(n[cell == -1].sum()) / rows, grad.reshape(w.shape) / rows

    w, best, worse = np.zeros((features, classes)), np.inf, 0
    found = Classifier(w.copy())
    second = np.full(w.shape, 1e-8)
    for step in range(1, steps + 1):
        _, grad = losses(sets[0], w, True)
        second += grad**2
        w = w - rate * grad / np.sqrt(second)
        if step % every == 0 or step == steps:
            loss, _ = losses(sets[1], w, False)
            found.history.append((step, loss))
            if loss < best - 1e-9:
                best, worse, found.weights = loss, 0, w.copy()
            else:
                worse += 1
                if worse >= patience:
                    break
    return found
