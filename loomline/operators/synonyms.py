"""Near-synonymous labels: embeddings, medoids, average-linkage clusters, merging into groups."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.labels import is_junk
from ..session import broadcast_if_small
from .labeling import SYNONYMS, rewrite, run_model

#: A clustering holds a square distance matrix of a vocabulary; beyond this it is refused rather than cut.
MAX_ITEMS = 8000


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))


def nonzero(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has a direction."""
    return df.where(norm(F.col(vector)) > 0)


def unit(vector: Column) -> Column:
    length = norm(vector)
    return F.transform(vector, lambda x: F.try_divide(x.cast("double"), length))  # a filter on the length may run later


def medoids(df: DataFrame, group: str, key: str, vector: str = "embedding", digits: int = 6) -> DataFrame:
    """The member of least summed cosine distance to its group, ties by key: group, key, sum_distance, members.

    The sum over a group's members is members - u . sum(u) for unit vectors u, so no pair is ever formed: one aggregation by dimension
    (combined on the map side, whatever the size of the group) and one join back by group. Zero vectors are left out.
    """
    units = nonzero(df, vector).select(group, key, unit(F.col(vector)).alias("__u"))
    per_dim = units.select(group, F.posexplode("__u").alias("d", "x")).groupBy(group, "d").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    sums = per_dim.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "s"))), lambda p: p["s"]).alias("__s"), F.max("n").alias("members"))
    both = units.join(broadcast_if_small(sums), group)
    dot = F.aggregate(F.zip_with("__u", "__s", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = both.select(group, key, "members", (F.round(F.col("members") - dot, digits) + 0.0).alias("sum_distance"))
    return scored.groupBy(group).agg(F.min(F.struct("sum_distance", key)).alias("m"), F.max("members").alias("members")).select(group, f"m.{key}", "m.sum_distance", "members")


def average_linkage(vectors: np.ndarray, threshold: float) -> np.ndarray:
    """Cluster numbers (by first member) of average linkage over cosine distance, merging while below the threshold.

    Nearest-neighbour chains find the same tree as greedy merging, in quadratic time.
    """
    n = len(vectors)
    if n == 0:
        return np.zeros(0, dtype=int)
    u = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    d = 1 - u @ u.T
    np.fill_diagonal(d, np.inf)
    size, alive, chain, merges = np.ones(n), np.ones(n, dtype=bool), [], []
    for _ in range(n - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            row = d[chain[-1]]
            near = int(np.argmin(row))
            if len(chain) > 1 and row[chain[-2]] <= row[near]:
                break
            chain.append(near)
        b, a = chain.pop(), chain.pop()
        merges.append((float(d[a, b]), a, b))
        row = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b])
        d[a], d[:, a] = row, row
        d[a, a] = np.inf
        d[b], d[:, b] = np.inf, np.inf
        alive[b], size[a] = False, size[a] + size[b]
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for height, a, b in merges:
        if height < threshold:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    roots = [root(i) for i in range(n)]
    names = {r: k for k, r in enumerate(dict.fromkeys(roots))}
    return np.array([names[r] for r in roots])


def clusters(df: DataFrame, run: str, key: str, vector: str = "embedding", threshold: float = 0.2) -> DataFrame:
    """(run, key, cluster) of each vocabulary ``run``. A vocabulary of over MAX_ITEMS labels raises; zero vectors are left out."""
    kinds = dict(df.dtypes)

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) > MAX_ITEMS:
            raise ValueError(f"a vocabulary of {len(frame)} labels; at most {MAX_ITEMS} can be clustered")
        frame = frame.sort_values(key, ignore_index=True)
        return frame[[run, key]].assign(cluster=average_linkage(np.array(frame[vector].tolist(), dtype=float), threshold))

    return nonzero(df.select(run, key, vector), vector).groupBy(run).applyInPandas(link, f"{run} {kinds[run]}, {key} {kinds[key]}, cluster int")


def hashed_embedding(labels: pd.Series, dim: int = 64) -> pd.Series:
    """A vector of hashed character trigrams: stands in for a text embedding."""
    from zlib import crc32

    def embed(label: str) -> list[float]:
        v = np.zeros(dim)
        padded = f"  {label.lower()} "
        for i in range(len(padded) - 2):
            h = crc32(padded[i : i + 3].encode())
            v[h % dim] += 1 if h & 0x80000000 else -1
        return v.tolist()

    return labels.map(embed)


def with_embedding(df: DataFrame, label: str = "label", dim: int = 64, batch: int = 32) -> DataFrame:
    """Adds ``embedding``, in batches; null labels give null."""

    @F.pandas_udf("array<double>")
    def embed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out = [hashed_embedding(part.iloc[i : i + batch].fillna(""), dim) for i in range(0, len(part), batch)]
            yield pd.concat(out).where(part.notna(), None) if out else part

    return df.withColumn("embedding", embed(F.col(label)))


def merge_groups(df: DataFrame, group: str = "name", words: str = "words") -> DataFrame:
    """Synonym groups of equal name united, their words distinct and sorted."""
    return df.select(group, F.explode(words).alias("w")).groupBy(group).agg(F.array_sort(F.collect_set("w")).alias(words))


def synonym_map(vocab: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(label, name) for each label of a cluster with several: named by the medoid. Fewer than two labels give no row.

    Clusters are taken as groups as they are; a review by a language model can stand between.
    """
    labels = vocab.select("label").where(F.col("label").isNotNull()).distinct().withColumn("run", F.lit(0))
    embedded = with_embedding(labels)
    linked = embedded.join(clusters(embedded, "run", "label", threshold=threshold).drop("run"), "label")
    names = medoids(linked, "cluster", "label").where(F.col("members") > 1).select("cluster", F.col("label").alias("name"))
    return linked.join(names, "cluster").select("label", "name")


def review(groups: DataFrame, make: Callable[[], Callable[[list[str]], list[str]]], attempts: int = 3) -> DataFrame:
    """Synonym groups (name, words) as a plug-in text model sees them: it is asked about groups of several words, single ones stay.

    The model may split, rename and unite groups; groups of equal name are united. A group without a usable answer stays as it is.
    """
    several = groups.where(F.size("words") > 1)
    head, tail = SYNONYMS.format(labels="\x00").split("\x00")
    asked = several.withColumn("prompt", F.concat(F.lit(head), F.array_join("words", ", "), F.lit(tail)))
    answered = run_model(asked, make, attempts, check=lambda text: repair_groups(text) is not None)
    told = F.from_json(repaired_groups(F.col("output")), "map<string,array<string>>")
    entries = F.map_entries(F.coalesce(told, F.map_from_arrays(F.array("name"), F.array("words"))))
    seen = answered.select(F.explode(entries).alias("e")).select(F.col("e.key").alias("name"), F.col("e.value").alias("words"))
    return merge_groups(seen.unionByName(groups.where(F.size("words") <= 1).select("name", "words")))


def repair_groups(text: str | None) -> str | None:
    """An object of lists of strings out of a model's answer; null when there is none."""
    if text is None or "{" not in text:
        return None
    try:
        found = json.loads(text[text.index("{") : text.rindex("}") + 1], strict=False)
    except ValueError:
        return None
    if not isinstance(found, dict) or not all(isinstance(v, list) and all(isinstance(x, str) for x in v) for v in found.values()):
        return None
    return json.dumps(found, ensure_ascii=False)


@F.pandas_udf(StringType())
def repaired_groups(texts: pd.Series) -> pd.Series:
    return texts.map(repair_groups, na_action="ignore").astype(object)


def candidates(vocab: DataFrame, threshold: float = 0.2) -> DataFrame:
    """(name, words): clusters of the labels of a vocabulary, named by their medoid; single labels are groups of one."""
    labels = vocab.select("label").where(F.col("label").isNotNull()).distinct().withColumn("run", F.lit(0))
    embedded = with_embedding(labels)
    linked = embedded.join(clusters(embedded, "run", "label", threshold=threshold).drop("run"), "label")
    names = medoids(linked, "cluster", "label").select("cluster", F.col("label").alias("name"))
    return linked.join(names, "cluster").groupBy("name").agg(F.array_sort(F.collect_set("label")).alias("words"))


def merge_synonyms(results: DataFrame, previous: DataFrame, vocab: DataFrame, make: Callable[[], Callable[[list[str]], list[str]]], threshold: float = 0.2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results, previous results, mapping): junk labels of a run and of the vocabulary so far clustered, reviewed by a model and rewritten in both.

    Results hold ``content``, an array of (line, label). Fewer than two labels leave everything as it is.
    """
    fresh = results.select(F.explode("content").alias("c")).select(F.col("c.label").alias("label")).where(is_junk(F.col("label")))
    groups = review(candidates(fresh.unionByName(vocab.select("label")), threshold), make)
    mapping = groups.select(F.explode("words").alias("label"), "name").where(F.col("label") != F.col("name")).groupBy("label").agg(F.min("name").alias("name"))
    # a mapping of a vocabulary is small; it goes into the expression, so that results are rewritten without a shuffle
    table = {r["label"]: r["name"] for r in mapping.limit(MAX_ITEMS + 1).collect()}
    if len(table) > MAX_ITEMS:
        raise ValueError(f"a mapping of over {MAX_ITEMS} labels")
    put = lambda df: df.withColumn("content", rewrite(F.col("content"), table))
    return put(results), put(previous), mapping


def apply_map(df: DataFrame, mapping: DataFrame, label: str = "label") -> DataFrame:
    """``label`` replaced by its group's name where it has one."""
    names = mapping.select(F.col("label").alias("__from"), F.col("name").alias("__name"))
    joined = df.join(broadcast_if_small(names), F.col(label) == F.col("__from"), "left")
    return joined.withColumn(label, F.coalesce("__name", label)).drop("__from", "__name")
