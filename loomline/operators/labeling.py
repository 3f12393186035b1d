"""Labelling by a language model: prompts, repair of its output, attaching labels to lines, the evolving vocabulary.

The model itself is a plug-in; a rule labeler stands in for it offline.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.labels import is_junk, repaired
from ..functions.lines import even_batches, let, numbered, split_stripped
from ..schema import CLEAN, LABELS
from .numbering import with_row_number

# Prompt templates in our own wording.
CLASSIFY = (
    "You sort the lines of a {language} web page by their use as training text.\nGive each line one label of: {labels}.\n"
    'Answer with a JSON object that maps "Line i" to its label and nothing else.\n\n{lines}'
)
GENERATE = (
    "You describe the lines of a {language} web page by their use as training text.\nA line that is good running text is Clean; name what is wrong "
    'with any other in one to three words. Known labels: {vocabulary}. Add a new one only if none fits.\nAnswer with a JSON object that maps "Line i" to its label.\n\n{lines}'
)
SYNONYMS = "These labels may mean the same: {labels}.\nAnswer with a JSON object that maps a group's name to the list of its labels; leave out labels that stand alone."


def prompts(df: DataFrame, text: str = "text", batch: int = 10, template: str = CLASSIFY, key: str = "id", **values: str) -> DataFrame:
    """One row per batch of a page's lines: key, batch_no, lines, prompt. Null texts give no rows."""
    batches = df.select(key, F.posexplode(even_batches(split_stripped(F.col(text)), batch)).alias("batch_no", "lines"))
    head, tail = template.format(**({"language": "", "labels": ", ".join(LABELS), "vocabulary": ""} | values), lines="\x00").split("\x00")
    return batches.withColumn("prompt", F.concat(F.lit(head), numbered(F.col("lines")), F.lit(tail)))


def repair_json(text: str | None) -> str | None:
    """An object of strings out of damaged JSON: code fences, trailing commas, missing quotes or braces. Null when nothing is left."""
    if text is None:
        return None
    body = text[text.find("{") :] if "{" in text else text
    for attempt in (body, re.sub(r",\s*([}\]])", r"\1", body), re.sub(r",\s*$", "", body) + "}", re.sub(r",\s*$", "", body) + '"}'):
        try:
            found = json.loads(attempt, strict=False)
            return json.dumps(found, ensure_ascii=False) if isinstance(found, dict) else None
        except ValueError:
            pass
    pairs = re.findall(r"[\"']?(Line \d+)[\"']?\s*:\s*[\"']?([^\"',}\n]+)", body)
    return json.dumps({k: v.strip() for k, v in pairs}, ensure_ascii=False) if pairs else None


@F.pandas_udf(StringType())
def repaired_json(texts: pd.Series) -> pd.Series:
    return texts.map(repair_json, na_action="ignore").astype(object)


def output_labels(output: Column) -> Column:
    """Labels of a model output in the order of its keys; damaged output goes through ``repaired_json`` as a column of its own first."""
    entries = F.map_entries(F.from_json(output, "map<string,string>"))
    return F.transform(entries, lambda e: e["value"])


def attach(lines: Column, labels: Column, valid: bool = True, compat: bool = False) -> Column:
    """array<struct<line, label>>: labels by position. Lines without label become Clean, or are dropped as the shorter side rules (``compat``)."""
    label = (lambda x: repaired(x)) if valid else (lambda x: F.coalesce(x, F.lit(CLEAN)))

    def pair(z: Column) -> Column:
        n = F.least(F.size(z["a"]), F.size(z["b"])) if compat else F.size(z["a"])
        zipped = F.slice(F.arrays_zip(z["a"], z["b"]), 1, n)
        return F.transform(zipped, lambda x: F.struct(x["a"].alias("line"), label(x["b"]).alias("label")))

    none = F.array().cast("array<string>")
    return F.when(lines.isNotNull(), let(F.struct(lines.alias("a"), F.coalesce(labels, none).alias("b")), pair))


def run_model(batches: DataFrame, make: Callable[[], Callable[[list[str]], list[str]]], attempts: int = 3, check: Callable[[str], bool] = bool, wait: float = 0) -> DataFrame:
    """Adds ``output`` of a plug-in text model, in Arrow batches; what fails the check is asked again, at most ``attempts`` times, then null.

    A call that raises is repeated once after ``wait`` seconds.
    """
    def ask(model: Callable[[list[str]], list[str]], texts: list[str]) -> list[str]:
        try:
            return model(texts)
        except Exception:
            time.sleep(wait)
            return model(texts)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for frame in frames:
            out: list[str | None] = [None] * len(frame)
            open_ = list(range(len(frame)))
            for _ in range(attempts):
                if not open_:
                    break
                for i, text in zip(open_, ask(model, [frame["prompt"].iloc[i] for i in open_]), strict=True):
                    out[i] = text if text is not None and check(text) else None
                open_ = [i for i in open_ if out[i] is None]
            yield frame.assign(output=pd.Series(out, index=frame.index, dtype=object))

    return batches.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batches.schema.fields) + ", output string")


def rule_labeler() -> Callable[[list[str]], list[str]]:
    """Stands in for a chat model: reads the lines of a prompt and answers by the rules of the rule scorer."""
    from .scoring import rule_model

    model = rule_model()

    def answer(prompt: str) -> str:
        lines = re.findall(r"^Line \d+: (.*)\n------$", prompt, flags=re.M)
        return json.dumps({f"Line {i + 1}": x for i, x in enumerate(model(lines)[0])})

    return lambda texts: [answer(x) for x in texts]


def junk_labels(lines: DataFrame, label: str = "label") -> DataFrame:
    return lines.where(is_junk(F.col(label))).select(F.col(label).alias("label"))


def vocabulary(lines: DataFrame, previous: DataFrame | None = None, label: str = "label") -> DataFrame:
    """(label, n) of junk labels, added to a persisted vocabulary where given."""
    counts = junk_labels(lines, label).groupBy("label").agg(F.count("*").alias("n"))
    if previous is None:
        return counts
    return counts.unionByName(previous.select("label", "n")).groupBy("label").agg(F.sum("n").alias("n"))


def top_labels(vocab: DataFrame, k: int) -> DataFrame:
    """The k most frequent labels, ties by name; -1 keeps all."""
    ordered = vocab.orderBy(F.desc("n"), "label")
    return ordered if k == -1 else ordered.limit(k)


def shuffled(vocab: DataFrame, seed: int = 0) -> DataFrame:
    return vocab.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "label")), "label")


def examples(lines: DataFrame, label: str, *order: str, k: int = 20) -> DataFrame:
    """The first k lines of each label; Catalyst prunes each partition to k per label before the shuffle."""
    window = Window.partitionBy(label).orderBy(*order)
    return lines.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def vocabulary_growth(lines: DataFrame, label: str, *order: str, every: int = 100) -> DataFrame:
    """(docs, labels): number of different labels among the first ``every``, 2 x ``every``, ... documents in order."""
    docs = with_row_number(lines.select(*order).distinct(), *order)
    first = lines.join(docs, list(order)).groupBy(label).agg(F.min("row_no").alias("first"))
    steps = first.groupBy((F.floor(F.col("first") / every) + 1).alias("step")).agg(F.count("*").alias("new"))
    window = Window.orderBy("step")  # one row per step at which something new came: bounded by the vocabulary
    return steps.select((F.col("step") * every).alias("docs"), F.sum("new").over(window).alias("labels"))


def tokens_estimate(text: Column) -> Column:
    """Estimated tokens: a quarter of the characters, rounded up."""
    return F.ceil(F.length(text) / 4)


def tokens_counted(text: Column, make: Callable[[], Callable[[str], int]]) -> Column:
    """Tokens by a plug-in tokenizer, made once per worker and run in Arrow batches; null for null."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = make()
        for batch in batches:
            yield batch.map(of, na_action="ignore").astype("Int64")

    return count(text)


def cost(prompt_tokens: Column, output_tokens: Column, input_price: float = 0.15, output_price: float = 0.6) -> Column:
    """Price of a call, from prices per million tokens."""
    return prompt_tokens * F.lit(input_price / 1e6) + output_tokens * F.lit(output_price / 1e6)


def mean_time(df: DataFrame, documents: str, seconds: str) -> DataFrame:
    """Documents, seconds and seconds a document over the batches of a run; null without documents."""
    n, s = F.sum(documents), F.sum(seconds)
    return df.agg(n.cast("bigint").alias("documents"), s.alias("seconds"), F.when(n > 0, s / n).alias("seconds_per_document"))


def rewrite(content: Column, synonyms: dict[str, str]) -> Column:
    """Labels of earlier results replaced by their group's name."""
    if not synonyms:
        return content
    table = F.create_map(*(F.lit(x) for kv in synonyms.items() for x in kv))
    return F.transform(content, lambda c: F.struct(c["line"].alias("line"), F.coalesce(F.element_at(table, c["label"]), c["label"]).alias("label")))


