"""Queries of the training-data problems over the test tables, whole tables and whole texts, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lines import SPACE
from ..session import broadcast_if_small
from . import abuse, boilerplate, language, pii, spam, textstats, topics, whole
from .bpe import token_counts, token_ids
from .cutoffs import cutoffs, source_name
from .packing import fill_report, pack_items
from .pages import latest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cutoff and kept size of each collection with a target."""
    rows = latest(table(spark, sf_dir, "annotated").select("id", "ingest_ts", "collection", "quality_scores"), "collection", "quality_scores")
    records = rows.select(source_name(F.col("collection")).alias("source"), F.col("quality_scores").alias("scores"))
    targets = table(spark, sf_dir, "keep_targets").withColumn("source", source_name(F.col("collection")))
    found = cutoffs(records, targets).join(broadcast_if_small(targets.select("source", "collection")), "source")
    return found.select("collection", F.round(F.col("cutoff") * 1000).cast("bigint").alias("cutoff_milli"), "kept")


_NAME = f"lower(regexp_replace(regexp_replace(collection, '^{SPACE}+', ''), '{SPACE}+$', ''))"
ORACLE["p1_found"] = f"""
WITH v AS (SELECT id, max({{'a': ingest_ts, 'b': collection, 'c': quality_scores}}) AS r FROM annotated WHERE id IS NOT NULL GROUP BY id),
s AS (SELECT {_NAME} AS source, unnest(q) AS s FROM (SELECT r.b AS collection, r.c AS q FROM v)),
k AS (SELECT collection, target_pct, s, count(*) OVER (PARTITION BY source) AS total, count(*) OVER (PARTITION BY source ORDER BY s DESC) AS kept
  FROM s JOIN (SELECT *, {_NAME} AS source FROM keep_targets) t USING (source) WHERE s IS NOT NULL AND NOT isnan(s) AND s BETWEEN 0 AND 1)
SELECT collection, CAST(round(1000 * max(s)) AS BIGINT) AS cutoff_milli, CAST(min(kept) AS BIGINT) AS kept FROM k WHERE 100 * kept >= target_pct * total GROUP BY collection"""


@query
def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return token_ids(table(spark, sf_dir, "documents"))


@query
def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in containers of every capacity; texts are tokenized once per tokenizer."""
    docs, specs = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_specs")
    names = sorted(r[0] for r in specs.select("tokenizer").where(F.col("tokenizer").isNotNull()).distinct().collect())
    rows = docs.count()
    return reduce(DataFrame.unionByName, [pack_items(token_counts(docs, n), specs.where(F.col("tokenizer") == n), count=rows) for n in names])


@query
def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    return fill_report(p9_containers(spark, sf_dir), table(spark, sf_dir, "pack_specs"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "annotated")


def _valid(results: DataFrame, *payload: str) -> DataFrame:
    """The results of the valid row of each id: texts are worked on where they lie, and only results are shuffled."""
    return latest(results, *payload)


@query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose body is mainly keyword, link or tag spam."""
    pages = _pages(spark, sf_dir)
    total = pages.count()
    if total > boilerplate.PAGES:
        return _valid(whole.spam_rows(pages, total), "spam").where("spam").select("id")
    # all rows of the table
    texts, labels = boilerplate.labelled_sample(pages, total)
    body = boilerplate.train(texts, labels)
    flagged = spam.spam_pages(pages.select("id", "ingest_ts", "text"), spam.train(texts, labels, body), body)
    return _valid(flagged, "spam").where("spam").select("id")


@query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines outside the main body."""
    pages = _pages(spark, sf_dir)
    marked = boilerplate.boilerplate_lines(pages.select("id", "ingest_ts", "text"), boilerplate.fit(pages))
    return _valid(marked, "boilerplate").select("id", F.explode("boilerplate").alias("line_no"))


@query
def p5_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main body of each row's text."""
    pages = _pages(spark, sf_dir)
    return boilerplate.main_text(pages.select("id", "ingest_ts", "text"), boilerplate.fit(pages))


@query
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a missing or wrong language, and lines in another language than the body."""
    pages = _pages(spark, sf_dir)
    told = language.languages(pages.select("id", "ingest_ts", "document_lang", "text"), *language.fit(pages))
    each = _valid(told, "document_lang", "languages").select("id", "document_lang", F.explode("languages").alias("x"))
    labelled = F.coalesce(F.col("document_lang"), F.lit("")) == F.col("x.lang")
    return each.where((F.col("x.line_no") >= 0) | ~labelled).select("id", "x.line_no", "x.lang")


@query
def p6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each page (line_no -1) and of each passage in another one, with its confidence."""
    pages = _pages(spark, sf_dir)
    told = language.languages(pages.select("id", "ingest_ts", "text"), *language.fit(pages))
    return _valid(told, "languages").select("id", F.explode("languages").alias("x")).select("id", "x.*")


@query
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose body is mainly no natural prose."""
    pages = _pages(spark, sf_dir)
    texts, labels = boilerplate.labelled_sample(pages)
    body = boilerplate.train(texts, labels)
    judged = textstats.junk_pages(pages.select("id", "ingest_ts", "text"), textstats.train(texts, labels, body), body)
    return _valid(judged, "no_prose").where(F.col("no_prose") > 0.5).select("id")


@query
def p7_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of each page beside the first of its document scores."""
    pages = _pages(spark, sf_dir)
    texts, labels = boilerplate.labelled_sample(pages)
    body = boilerplate.train(texts, labels)
    rows = pages.select("id", "ingest_ts", F.get("doc_scores", F.lit(0)).alias("doc_score"), "text")
    stats = textstats.text_statistics(rows, textstats.train(texts, labels, body), body)
    return _valid(stats, *(c for c in stats.columns if c not in ("id", "ingest_ts")))


def _abuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = abuse.abusive_pages(_pages(spark, sf_dir).select("id", "ingest_ts", source_name(F.col("collection")).alias("collection"), "text"))
    return _valid(scored, "abuse_score", "collection")


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with abusive, hateful or sexually explicit language."""
    return _abuse(spark, sf_dir).where(F.col("abuse_score") >= 1 - 1e-6).select("id")


@query
def p3_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of each page."""
    return _abuse(spark, sf_dir).select("id", "abuse_score")


@query
def p3_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, flagged pages and their rate per collection; pages without collection stand under null."""
    flag = F.col("abuse_score") >= 1 - 1e-6
    rates = _abuse(spark, sf_dir).groupBy("collection").agg(F.count("*").alias("pages"), F.count_if(flag).alias("flagged"))
    return rates.withColumn("rate", F.col("flagged") / F.col("pages"))


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every different string of personal data of each page."""
    pages = _pages(spark, sf_dir)
    found = pii.personal_data(pages.select("id", "ingest_ts", "text"), pii.fit(*boilerplate.labelled_sample(pages, pii.PAGES)))
    each = _valid(found.withColumn("found", F.array_distinct("found")), "found").select("id", F.explode("found").alias("x"))
    return each.select("id", "x.pii_type", "x.pii_text")


@query
def p4_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's text with typed placeholders."""
    pages = _pages(spark, sf_dir)
    return pii.masked_text(pages.select("id", "ingest_ts", "text"), pii.fit(*boilerplate.labelled_sample(pages, pii.PAGES)))


def _topics(spark: SparkSession, sf_dir: str) -> topics.Fitted:
    body = boilerplate.fit(_pages(spark, sf_dir))
    return topics.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_labels"), table(spark, sf_dir, "subject_areas"), body)


@query
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subjects that each document treats."""
    return topics.document_subjects(_topics(spark, sf_dir)).select("doc_id", "subject")


@query
def p10_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topics with their top terms and subjects."""
    return topics.inspect(_topics(spark, sf_dir))


@query
def p10_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by subject."""
    return topics.document_subjects(_topics(spark, sf_dir)).groupBy("subject").agg(F.count("*").alias("docs"))
