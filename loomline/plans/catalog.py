"""Named queries of the core operators over the test tables, each with the same result in ANSI SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lines as L
from ..functions.labels import canonical, is_junk, language_name, repaired
from ..operators import analysis as A
from ..operators import labeling as B
from ..operators import quality as Q
from ..operators import sampling as P
from ..operators import scoring as R
from ..operators import synonyms as S
from ..operators import training as T
from ..operators.mask import mask
from ..operators.numbering import positional_slice
from ..schema import LABELS, LANGUAGE_OF_CODE, parse_labels
from ..session import scratch
from ..sources import readers as I
from ..sources import writers as W
from ..sources.readers import parsed_record, valid_record
from ..sources.writers import split_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, source: str, sql: str | None = None) -> Callable:
    """Registers a function of one table, or of several named with blanks between."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(*(table(spark, sf_dir, t) for t in source.split()))
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


def rounded(x: Column | str, digits: int = 6) -> Column:
    """Rounded the same way by both engines: their own rounding differs on halves."""
    return F.floor(F.col(x) * 10.0**digits + 0.5001) / 10.0**digits if isinstance(x, str) else F.floor(x * 10.0**digits + 0.5001) / 10.0**digits


def sql_rounded(x: str, digits: int = 6) -> str:
    return f"floor({x} * 1e{digits} + 0.5001) / 1e{digits}"


# Pieces of SQL.
NL = "chr(10)"


def sql_strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{L.SPACE}+', ''), '{L.SPACE}+$', '')"


def sql_canonical(x: str) -> str:
    cases = " ".join(f"WHEN '{label.lower()}' THEN '{label}'" for label in LABELS)
    return f"(CASE lower({sql_strip(x)}) {cases} ELSE {x} END)"


def sql_in(labels: list[str]) -> str:
    return "(" + ", ".join(f"'{x}'" for x in labels) + ")"


Z = f"""
z AS (
  SELECT *, list_transform(range(1, len(lines) + 1), lambda i: {{'line': lines[i], 'label': line_quality_labels[i], 'score': quality_scores[i], 'lang': langs[i]}}) AS z
  FROM (SELECT *, string_split(text, {NL}) AS lines FROM annotated WHERE text IS NOT NULL)
)"""


def sql_mask(keep: str, mode: str, columns: str = "", where: str = "true", after: str = "text <> ''") -> str:
    """The text that a mask leaves; keep speaks of a struct x."""
    flagged = f"f AS (SELECT *, list_transform(z, lambda x: coalesce({keep}, false)) AS flags FROM z WHERE {where})"
    bounds = "b AS (SELECT *, coalesce(list_position(flags, true), 0) AS lo, len(flags) + 1 - coalesce(list_position(list_reverse(flags), true), 0) AS hi FROM f)"
    chosen = "list_filter(range(1, len(lines) + 1), lambda i: flags[i])" if mode == "filter" else "CASE WHEN lo = 0 THEN [] ELSE range(lo, hi + 1) END"
    out = f"o AS (SELECT id, ingest_ts, {columns} array_to_string(list_transform(k, lambda i: lines[i]), {NL}) AS text, CAST(len(k) AS BIGINT) AS n_lines FROM (SELECT *, {chosen} AS k FROM b))"
    return f"WITH {Z}, {flagged}, {bounds}, {out} SELECT * FROM o WHERE {after}"


def counted(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Runs a mask and counts the lines of its text; a text that a mask left empty has none, or one blank line, and is dropped."""
    return lambda df: f(df).select("id", "ingest_ts", "text", F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines"))


# Lines.
@query("line_split", "documents", f"SELECT doc_id, CAST(pos AS BIGINT) AS pos, line FROM (SELECT doc_id, unnest(range(0, len(s))) AS pos, unnest(s) AS line FROM (SELECT doc_id, string_split(text, {NL}) AS s FROM documents WHERE text IS NOT NULL))")
def line_split(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.posexplode(L.split_lines(F.col("text"))).alias("pos", "line")).withColumn("pos", F.col("pos").cast("bigint"))


_UNI = f"(SELECT id, ingest_ts, CASE WHEN s[-1] = '' THEN s[1:-2] ELSE s END AS s FROM (SELECT *, string_split_regex(text, '{L.UNIVERSAL}') AS s FROM annotated WHERE text IS NOT NULL))"


@query("line_splitlines", "annotated", f"SELECT id, ingest_ts, CAST(len(s) AS BIGINT) AS n_lines, array_to_string(s, '¶') AS joined FROM {_UNI}")
def line_splitlines(df: DataFrame) -> DataFrame:
    s = L.split_universal(F.col("text"))
    return df.where(F.col("text").isNotNull()).select("id", "ingest_ts", F.size(s).cast("bigint").alias("n_lines"), F.array_join(s, "¶").alias("joined"))


@query("line_split_stripped", "annotated", f"SELECT id, ingest_ts, CAST(len(s) AS BIGINT) AS n_lines, array_to_string(s, {NL}) AS text FROM (SELECT *, string_split({sql_strip('text')}, {NL}) AS s FROM annotated WHERE text IS NOT NULL)")
def line_split_stripped(df: DataFrame) -> DataFrame:
    s = L.split_stripped(F.col("text"))
    return df.where(F.col("text").isNotNull()).select("id", "ingest_ts", F.size(s).cast("bigint").alias("n_lines"), L.join_lines(s).alias("text"))


@query("line_count", "annotated", f"SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(string_split(text, {NL}))) AS BIGINT) AS n_lines FROM annotated")
def line_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_docs"), F.sum(F.when(F.col("text").isNotNull(), F.size(L.split_lines(F.col("text"))))).cast("bigint").alias("n_lines"))


_BATCH = f"""
WITH l AS (SELECT doc_id, unnest(range(0, len(s))) AS pos, unnest(s) AS line, len(s) AS n FROM (SELECT doc_id, string_split({sql_strip('text')}, {NL}) AS s FROM documents WHERE text IS NOT NULL)),
k AS (SELECT *, CAST(ceil(n / 10) AS BIGINT) AS k FROM l),
b AS (SELECT *, CASE WHEN pos < (n % k) * (n // k + 1) THEN pos // (n // k + 1) ELSE n % k + (pos - (n % k) * (n // k + 1)) // (n // k) END AS batch_no FROM k)"""


@query("line_batches", "documents", f"{_BATCH} SELECT doc_id, CAST(batch_no AS BIGINT) AS batch_no, CAST(count(*) AS BIGINT) AS n_lines, string_agg(line, {NL} ORDER BY pos) AS lines FROM b GROUP BY ALL")
def line_batches(docs: DataFrame) -> DataFrame:
    batches = docs.select("doc_id", F.posexplode(L.even_batches(L.split_stripped(F.col("text")), 10)).alias("b", "x"))
    return batches.select("doc_id", F.col("b").cast("bigint").alias("batch_no"), F.size("x").cast("bigint").alias("n_lines"), L.join_lines(F.col("x")).alias("lines"))


_PROMPT_HEAD, _PROMPT_TAIL = B.CLASSIFY.format(language="", labels=", ".join(LABELS), lines="\x00").split("\x00")
_LIT = lambda s: "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


@query("prompt_lines", "documents", f"{_BATCH}, m AS (SELECT *, row_number() OVER (PARTITION BY doc_id, batch_no ORDER BY pos) AS i FROM b) SELECT doc_id, CAST(batch_no AS BIGINT) AS batch_no, {_LIT(_PROMPT_HEAD)} || string_agg('Line ' || i || ': ' || line || chr(10) || '------' || chr(10), '' ORDER BY i) || {_LIT(_PROMPT_TAIL)} AS prompt FROM m GROUP BY ALL")
def prompt_lines(docs: DataFrame) -> DataFrame:
    return B.prompts(docs, key="doc_id").select("doc_id", F.col("batch_no").cast("bigint").alias("batch_no"), "prompt")


# Sentences are put together in a string, pieces apart by chr(1); the last piece is the open one.
_PUT = "CASE WHEN length(string_split(a, chr(1))[-1]) + length(x) + 1 <= 200 THEN a || ' ' || x ELSE a || chr(1) || x END"
_SENTENCES = rf"string_split(regexp_replace(text, '([.!?]){L.SPACE}+', '\1' || chr(2), 'g'), chr(2))"
_PIECES = f"(SELECT doc_id, string_split(list_reduce({_SENTENCES}, lambda a, x: {_PUT}, ''), chr(1)) AS p FROM documents WHERE NOT contains(text, {NL}) AND length(text) > 200)"


@query("long_line_segments", "documents", f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, {sql_strip('segment')} AS segment FROM (SELECT doc_id, unnest(range(0, len(p))) AS pos, unnest(p) AS segment FROM (SELECT doc_id, CASE WHEN p[-1] = '' THEN p[1:-2] ELSE p END AS p FROM {_PIECES}))")
def long_line_segments(docs: DataFrame) -> DataFrame:
    single = docs.where(~F.contains("text", F.lit("\n")) & (F.length("text") > 200))
    return single.select("doc_id", F.posexplode(L.segments(F.col("text"))).alias("pos", "segment"))


@query("doc_language_argmax", "raw_docs", "SELECT id, lang[list_position(prob, list_max(prob))] AS document_lang FROM raw_docs")
def doc_language_argmax(raw: DataFrame) -> DataFrame:
    return raw.select("id", L.argmax(F.col("lang"), F.col("prob")).alias("document_lang"))


@query("raw_to_annotated", "raw_docs", "SELECT text, id, array_to_string(list_transform(seg_langs, lambda x: coalesce(x, '-')), ' ') AS langs, robotstxt, collection, u AS url, lang[list_position(prob, list_max(prob))] AS document_lang, doc_scores[1] AS doc_score FROM raw_docs")
def raw_to_annotated(raw: DataFrame) -> DataFrame:
    langs = F.array_join(F.transform("langs", lambda x: F.coalesce(x, F.lit("-"))), " ")
    return Q.to_annotated(raw).withColumns({"langs": langs, "doc_score": F.get("doc_scores", F.lit(0))}).drop("doc_scores")


_NAMES = ", ".join(f"('{c}', '{n}')" for c, n in LANGUAGE_OF_CODE.items())


@query("language_names", "annotated", f"SELECT document_lang, name AS language, CAST(count(*) AS BIGINT) AS n FROM annotated LEFT JOIN (VALUES {_NAMES}) t(code, name) ON document_lang = code GROUP BY ALL")
def language_names(df: DataFrame) -> DataFrame:
    return df.groupBy("document_lang").agg(F.count("*").alias("n")).withColumn("language", language_name(F.col("document_lang"), strict=False))


# Masks.
_REMOVE = parse_labels("all")
_BY_LABEL = f"NOT coalesce({sql_canonical('x.label')} IN {sql_in(_REMOVE)}, false)"
_BY_SCORE = "NOT isnan(x.score) AND x.score >= 0.8"
QUERIES["filter_by_label"] = lambda s, d: counted(lambda df: Q.by_label(df, _REMOVE))(table(s, d, "annotated"))
ORACLE["filter_by_label"] = sql_mask(_BY_LABEL, "filter")
QUERIES["trim_by_label"] = lambda s, d: counted(lambda df: Q.by_label(df, _REMOVE, "trim"))(table(s, d, "annotated"))
ORACLE["trim_by_label"] = sql_mask(_BY_LABEL, "trim")
_SOME = parse_labels("spam, toxic,interface")
QUERIES["filter_by_some_labels"] = lambda s, d: counted(lambda df: Q.by_label(df, _SOME))(table(s, d, "annotated"))
ORACLE["filter_by_some_labels"] = sql_mask(f"NOT coalesce({sql_canonical('x.label')} IN {sql_in(_SOME)}, false)", "filter")
QUERIES["filter_by_score"] = lambda s, d: counted(lambda df: Q.by_score(df, 0.8))(table(s, d, "annotated"))
ORACLE["filter_by_score"] = sql_mask(_BY_SCORE, "filter")
QUERIES["trim_by_score"] = lambda s, d: counted(lambda df: Q.by_score(df, 0.8, "trim"))(table(s, d, "annotated"))
ORACLE["trim_by_score"] = sql_mask(_BY_SCORE, "trim")

_TUPLE = r"regexp_replace(" + sql_strip("line_quality") + r", '^\(([^()]*?),?\s*\)$', '[\1]')"
_NUMBERS = rf"CASE WHEN regexp_matches(t, '^\[\s*(?:(?:-?[0-9.]+(?:[eE][-+]?[0-9]+)?|None|null)\s*(?:,\s*(?:-?[0-9.]+(?:[eE][-+]?[0-9]+)?|None|null)\s*)*)?\]$') THEN try_cast(replace(replace(t, 'None', 'NULL'), 'null', 'NULL') AS DOUBLE[]) END"


@query("score_literal_parse", "scored", f"SELECT id, v IS NOT NULL AS valid, CAST(len(v) AS BIGINT) AS n_scores, round(list_sum(v), 6) AS total, CAST(count(*) AS BIGINT) AS n FROM (SELECT id, {_NUMBERS} AS v FROM (SELECT id, {_TUPLE} AS t FROM scored)) GROUP BY ALL")
def score_literal_parse(df: DataFrame) -> DataFrame:
    v = L.score_list(F.col("line_quality"))
    known = F.filter(v, lambda x: x.isNotNull())
    total = F.when(F.size(known) > 0, F.round(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), 6))
    out = df.select("id", v.isNotNull().alias("valid"), F.when(v.isNotNull(), F.size(v)).cast("bigint").alias("n_scores"), total.alias("total"))
    return out.groupBy("id", "valid", "n_scores", "total").agg(F.count("*").alias("n"))


@query("scored_filter", "scored", f"SELECT id, text, CAST(count(*) AS BIGINT) AS n FROM (SELECT id, array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: coalesce(v[i] >= 0.8, false)), lambda i: l[i]), {NL}) AS text FROM (SELECT id, string_split(text, {NL}) AS l, {_NUMBERS} AS v FROM (SELECT id, text, {_TUPLE} AS t FROM scored WHERE text IS NOT NULL))) WHERE text <> '' GROUP BY ALL")
def scored_filter(df: DataFrame) -> DataFrame:
    parsed = df.withColumn("line_quality", L.score_list(F.col("line_quality")))
    return Q.by_score(parsed, 0.8, scores="line_quality").groupBy("id", "text").agg(F.count("*").alias("n"))


_WEAK = "doc_scores[1] < 5 AND length(text) >= 250 AND robotstxt = 'allowed'"
_CLEAN = f"{sql_canonical('x.label')} = 'Clean'"
_LANG = Z.replace("'lang': langs[i]", "'lang': langs[i], 'dl': document_lang")
QUERIES["salvage_filter"] = lambda s, d: counted(Q.salvage)(table(s, d, "annotated"))
ORACLE["salvage_filter"] = sql_mask(f"{_CLEAN} AND NOT isnan(x.score) AND x.score > 0.9 AND x.lang = x.dl", "filter", where=_WEAK, after="length(text) >= 250").replace(Z, _LANG)
QUERIES["salvage_trim"] = lambda s, d: counted(lambda df: Q.salvage(df, "trim"))(table(s, d, "annotated"))
ORACLE["salvage_trim"] = sql_mask(_CLEAN, "trim", where=_WEAK, after="length(text) >= 250")


@query("min_length", "documents", "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 250")
def min_length(docs: DataFrame) -> DataFrame:
    return Q.long_enough(docs).select("doc_id", "n_chars")


@query("robots_allowed", "annotated", "SELECT id, ingest_ts FROM annotated WHERE text <> '' AND robotstxt = 'allowed'")
def robots_allowed(df: DataFrame) -> DataFrame:
    return Q.allowed(df).select("id", "ingest_ts")


# Rule scorer.
_RULE = "CASE " + " ".join(f"WHEN regexp_matches(line, '{p}') THEN '{R.SHORTHANDS[s]}'" for p, s in R.RULES) + f" WHEN length(line) < {R.SHORT} THEN '{R.SHORTHANDS['interface']}' ELSE 'Clean' END"
_RULED = f"(SELECT doc_id, pos, line, {_RULE} AS label, round(length(regexp_replace(line, '[^A-Za-z]', '', 'g')) / greatest(length(line), 1), 3) AS score FROM (SELECT doc_id, unnest(range(0, len(s))) AS pos, unnest(s) AS line FROM (SELECT doc_id, string_split(text, {NL}) AS s FROM documents WHERE text IS NOT NULL)))"


@query("rule_labels", "documents", f"SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs, round(avg(score), 6) AS mean_score FROM {_RULED} GROUP BY label")
def rule_labels(docs: DataFrame) -> DataFrame:
    scored = R.annotate_by_rules(docs).select("doc_id", F.explode(F.arrays_zip("line_quality_labels", "quality_scores")).alias("z"))
    return scored.groupBy(F.col("z.line_quality_labels").alias("label")).agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"), F.round(F.avg("z.quality_scores"), 6).alias("mean_score"))


@query("rule_filter", "documents", f"SELECT doc_id, string_agg(line, {NL} ORDER BY pos) AS text FROM {_RULED} WHERE label = 'Clean' GROUP BY doc_id HAVING string_agg(line, {NL} ORDER BY pos) <> ''")
def rule_filter(docs: DataFrame) -> DataFrame:
    out = mask(R.annotate_by_rules(docs), ["line_quality_labels"], lambda z: z["line_quality_labels"] == "Clean", leave=Q.filled)
    return out.select("doc_id", "text")


@query("model_labels", "documents", f"SELECT label, CAST(count(*) AS BIGINT) AS n FROM {_RULED} GROUP BY label")
def model_labels(docs: DataFrame) -> DataFrame:
    scored = R.annotate_by_model(docs.select("doc_id", "text"), R.rule_model)
    return scored.select("doc_id", F.explode("line_quality_labels").alias("label")).groupBy("label").agg(F.count("*").alias("n"))


# Aggregates.
@query("label_counts", "annotated", "SELECT label, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(line_quality_labels) AS label FROM annotated) GROUP BY label")
def label_counts(df: DataFrame) -> DataFrame:
    return A.label_frequency(df)


@query("clean_share", "annotated", f"SELECT CAST(count(*) AS BIGINT) AS n_lines, round(avg(CAST({sql_canonical('label')} = 'Clean' AS INT)), 6) AS clean_share FROM (SELECT unnest(line_quality_labels) AS label FROM annotated) WHERE label IS NOT NULL")
def clean_share(df: DataFrame) -> DataFrame:
    return A.clean_share(df).withColumn("clean_share", F.round("clean_share", 6))


@query("distinct_labels", "llm_result", "SELECT DISTINCT label FROM (SELECT unnest(content).label AS label FROM llm_result)")
def distinct_labels(df: DataFrame) -> DataFrame:
    return df.select(F.explode("content").alias("c")).select("c.label").distinct()


_METRICS = f"""
m AS (
  SELECT id, ingest_ts, doc_scores[1] AS doc_score,
    list_filter(quality_scores, lambda s: s IS NOT NULL AND NOT isnan(s) AND s >= 0 AND s <= 1) AS s,
    list_filter(line_quality_labels, lambda l: l IS NOT NULL) AS l FROM annotated
), dm AS (
  SELECT id, ingest_ts, doc_score, list_avg(s) AS mean_line_score, list_median(s) AS median_line_score, list_min(s) AS min_line_score,
    CASE WHEN len(l) > 0 THEN len(list_filter(l, lambda x: {sql_canonical('x')} = 'Clean')) END AS n_clean, CASE WHEN len(l) > 0 THEN len(l) END AS n_lines FROM m
)"""
_BUCKET = "CASE WHEN 3 * n_clean >= 2 * n_lines THEN 'Clean' WHEN 3 * n_clean > n_lines THEN 'Mixed' WHEN n_lines IS NOT NULL THEN 'Non-Clean' END"


@query("doc_metrics", "annotated", f"WITH {_METRICS} SELECT id, ingest_ts, doc_score, {sql_rounded('mean_line_score')} AS mean_line_score, {sql_rounded('median_line_score')} AS median_line_score, min_line_score, {sql_rounded('n_clean / n_lines')} AS clean_fraction FROM dm")
def doc_metrics(df: DataFrame) -> DataFrame:
    out = A.doc_metrics(df, ["id", "ingest_ts"]).drop("n_clean", "n_lines")
    return out.withColumns({c: rounded(c) for c in ("mean_line_score", "median_line_score", "clean_fraction")})


@query("cleanliness_bucket", "annotated", f"WITH {_METRICS} SELECT {_BUCKET} AS bucket, CAST(count(*) AS BIGINT) AS n FROM dm GROUP BY 1")
def cleanliness_bucket(df: DataFrame) -> DataFrame:
    m = A.doc_metrics(df, ["id", "ingest_ts"])
    return m.groupBy(A.bucket(F.col("n_clean"), F.col("n_lines")).alias("bucket")).agg(F.count("*").alias("n"))


_PRED = f"""
p AS (SELECT text, nemotron_label, hplt_doc_score FROM doc_pred),
t AS (SELECT text, min({_BUCKET.replace('n_clean', 'dm.n_clean').replace('n_lines', 'dm.n_lines')}) AS bucket FROM annotated JOIN dm USING (id, ingest_ts) WHERE text IS NOT NULL GROUP BY text)"""


@query("crosstab", "annotated doc_pred", f"WITH {_METRICS}, {_PRED} SELECT b.bucket, CAST(coalesce(sum(CAST(nemotron_label = 'Low' AS INT)), 0) AS BIGINT) AS \"Low\", CAST(coalesce(sum(CAST(nemotron_label = 'Medium' AS INT)), 0) AS BIGINT) AS \"Medium\", CAST(coalesce(sum(CAST(nemotron_label = 'High' AS INT)), 0) AS BIGINT) AS \"High\" FROM (VALUES ('Clean'), ('Mixed'), ('Non-Clean')) b(bucket) LEFT JOIN (SELECT * FROM t JOIN p USING (text)) j ON j.bucket = b.bucket GROUP BY b.bucket")
def crosstab(df: DataFrame, pred: DataFrame) -> DataFrame:
    # texts meet by a digest of 128 bits, so that they need not be shuffled
    m = A.doc_metrics(df.where(F.col("text").isNotNull()).withColumn("digest", F.md5("text")), ["digest"])
    buckets = m.groupBy("digest").agg(F.min(A.bucket(F.col("n_clean"), F.col("n_lines"))).alias("bucket"))
    told = pred.select(F.md5("text").alias("digest"), "nemotron_label")
    return A.crosstab(buckets.join(told, "digest"), "bucket", "nemotron_label", ["Low", "Medium", "High"], A.BUCKETS)


_NAMES4 = ["mean_line_score", "median_line_score", "min_line_score", "clean_fraction"]
_CORR = " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST(count(*) AS BIGINT) AS n, round(corr(doc_score, {m}), 6) AS r FROM (SELECT *, n_clean / n_lines AS clean_fraction FROM dm) WHERE doc_score IS NOT NULL AND {m} IS NOT NULL" for m in _NAMES4)


@query("corr_doc_line", "annotated", f"WITH {_METRICS} {_CORR}")
def corr_doc_line(df: DataFrame) -> DataFrame:
    return A.correlation(A.doc_metrics(df, ["id"]), "doc_score", _NAMES4).withColumn("r", F.round("r", 6))


@query("corr_doc_line_p", "annotated")
def corr_doc_line_p(df: DataFrame) -> DataFrame:
    return A.correlation_with_p(A.doc_metrics(df, ["id"]), "doc_score", _NAMES4)


@query("box_stats", "doc_pred", """
WITH q AS (SELECT nemotron_label, CAST(count(*) AS BIGINT) AS n, min(hplt_doc_score) AS least, max(hplt_doc_score) AS most, quantile_cont(hplt_doc_score, 0.25) AS q1, quantile_cont(hplt_doc_score, 0.5) AS median, quantile_cont(hplt_doc_score, 0.75) AS q3
  FROM doc_pred WHERE hplt_doc_score IS NOT NULL AND nemotron_label IS NOT NULL GROUP BY 1)
SELECT q.nemotron_label, any_value(q.n) AS n, any_value(least) AS least, any_value(most) AS most, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
  min(hplt_doc_score) FILTER (hplt_doc_score >= q1 - 1.5 * (q3 - q1)) AS low_whisker, max(hplt_doc_score) FILTER (hplt_doc_score <= q3 + 1.5 * (q3 - q1)) AS high_whisker
FROM q JOIN doc_pred d ON q.nemotron_label = d.nemotron_label AND d.hplt_doc_score IS NOT NULL GROUP BY 1""")
def box_stats(df: DataFrame) -> DataFrame:
    return A.box_stats(df.where(F.col("nemotron_label").isNotNull()), "nemotron_label", "hplt_doc_score").withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("regression", "annotated", f"WITH {_METRICS} SELECT CAST(count(*) AS BIGINT) AS n, round(regr_slope(doc_score, mean_line_score), 5) AS slope, round(regr_intercept(doc_score, mean_line_score), 5) AS intercept FROM dm WHERE doc_score IS NOT NULL AND mean_line_score IS NOT NULL")
def regression(df: DataFrame) -> DataFrame:
    return A.regression(A.doc_metrics(df, ["id"]), "mean_line_score", "doc_score").withColumns({c: F.round(c, 5) for c in ("slope", "intercept")})


# Training sets; the labelled lines of the language model are the input.
_FLAT = f"(SELECT r.id AS id, k, c.line AS text, CASE WHEN {sql_canonical('c.label')} IN {sql_in(LABELS)} THEN {sql_canonical('c.label')} ELSE 'Clean' END AS label FROM (SELECT doc AS r, unnest(range(0, len(content))) AS k, unnest(content) AS c FROM llm_result) WHERE c.line IS NOT NULL)"
_KEY = "md5(concat_ws(chr(1), id, CAST(k AS VARCHAR), text))"


def _flat(results: DataFrame) -> DataFrame:
    lines = results.select(F.col("doc.id").alias("id"), F.posexplode("content").alias("k", "c")).where(F.col("c.line").isNotNull())
    return lines.select("id", F.col("k").cast("bigint").alias("k"), F.col("c.line").alias("text"), repaired(F.col("c.label")).alias("label"))


@query("training_lines", "llm_result", f"SELECT text, label FROM {_FLAT}")
def training_lines(results: DataFrame) -> DataFrame:
    return T.flatten(results)


@query("downsample_clean", "llm_result", f"SELECT id, k, text, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_KEY}, id, k, text) AS r, count(*) OVER (PARTITION BY label) AS n FROM {_FLAT}) WHERE label <> 'Clean' OR r <= round_even(0.2 * n, 0)")
def downsample_clean(results: DataFrame) -> DataFrame:
    return T.downsample(_flat(results), 0.2, ("id", "k", "text"))


@query("stratified_split", "llm_result", f"SELECT id, k, label, CASE WHEN (r - 1) * 100 < n * 70 THEN 'train' WHEN (r - 1) * 100 < n * 85 THEN 'validation' ELSE 'test' END AS split FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_KEY}, id, k, text) AS r, count(*) OVER (PARTITION BY label) AS n FROM {_FLAT})")
def stratified_split(results: DataFrame) -> DataFrame:
    return T.stratified_split(_flat(results), key=("id", "k", "text")).drop("text")


@query("label_encode", "llm_result", f"SELECT id, k, f.label, CAST(code AS INT) AS code FROM {_FLAT} f JOIN (SELECT label, row_number() OVER (ORDER BY label <> 'Clean', label) - 1 AS code FROM (SELECT DISTINCT label FROM {_FLAT})) m ON f.label = m.label")
def label_encode(results: DataFrame) -> DataFrame:
    return T.encode(_flat(results)).drop("text")


@query("class_weights", "llm_result", f"SELECT label, CAST(count(*) AS BIGINT) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM {_FLAT} GROUP BY label")
def class_weights(results: DataFrame) -> DataFrame:
    return A.class_weights(_flat(results)).withColumn("weight", F.round("weight", 6))


_GUESS = f"(SELECT truth, guess FROM (SELECT {sql_canonical('line_quality_labels[pos + 1]')} AS truth, {_RULE} AS guess FROM (SELECT line_quality_labels, unnest(range(0, len(s))) AS pos, unnest(s) AS line FROM (SELECT line_quality_labels, string_split(text, {NL}) AS s FROM annotated WHERE text IS NOT NULL))) WHERE truth IN {sql_in(LABELS)})"


def _guesses(df: DataFrame) -> DataFrame:
    # labels are made canonical once, in their array: after the explode a filter on them would do it again for every line
    both = F.arrays_zip(L.split_lines(F.col("text")).alias("line"), F.transform("line_quality_labels", canonical).alias("truth"))
    lines = df.where(F.col("text").isNotNull()).select(F.explode(both).alias("z")).where(F.col("z.truth").isin(LABELS) & F.col("z.line").isNotNull())
    return lines.select(F.col("z.truth").alias("truth"), R.rule_label(F.col("z.line")).alias("guess"))


@query("confusion", "annotated", f"SELECT truth, guess, CAST(count(*) AS BIGINT) AS n FROM {_GUESS} GROUP BY ALL")
def confusion(df: DataFrame) -> DataFrame:
    return A.confusion(_guesses(df))


_REPORT = f"""
g AS (SELECT * FROM {_GUESS}), l AS (SELECT truth AS label FROM g UNION SELECT guess FROM g),
r AS (SELECT label, (SELECT count(*) FROM g WHERE truth = label) AS support, (SELECT count(*) FROM g WHERE guess = label) AS guessed, (SELECT count(*) FROM g WHERE truth = label AND guess = label) AS hit FROM l),
s AS (SELECT *, CASE WHEN guessed > 0 THEN hit / guessed ELSE 0 END AS precision, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall, CASE WHEN hit > 0 THEN 2 * hit / (support + guessed) ELSE 0 END AS f1 FROM r)"""


@query("class_report", "annotated", f"WITH {_REPORT} SELECT label, CAST(support AS BIGINT) AS support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM s")
def class_report(df: DataFrame) -> DataFrame:
    return A.class_report(A.confusion(_guesses(df))).select("label", "support", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@query("classification_metrics", "annotated", f"WITH {_REPORT} SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(hit) / sum(support), 6) AS accuracy, round(sum(hit) / sum(support), 6) AS micro_f1, round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1, round(sum(precision * support) / sum(support), 6) AS weighted_precision, round(sum(recall * support) / sum(support), 6) AS weighted_recall FROM s")
def classification_metrics(df: DataFrame) -> DataFrame:
    out = A.classification_metrics(_guesses(df))
    return out.select("n", *(F.round(c, 6).alias(c) for c in out.columns if c != "n"))


@query("trained_scorer", "llm_result")
def trained_scorer(results: DataFrame) -> DataFrame:
    data = T.encode(T.stratified_split(_flat(results), key=("id", "k", "text")))
    train = data.where(F.col("split") == "train")
    model = T.line_classifier(train, A.class_weights(train))
    return A.classification_metrics(model.transform(data.where(F.col("split") == "test")).select(F.col("code").alias("truth"), F.col("prediction").cast("int").alias("guess")))


# Splits, samples, joins.
@query("split_parts", "documents", "SELECT doc_id, CAST(ntile(7) OVER (ORDER BY doc_id) - 1 AS INT) AS part FROM documents")
def split_parts(docs: DataFrame) -> DataFrame:
    return split_rows(docs.select("doc_id"), 7, "doc_id")


@query("split_ceil", "documents", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // CAST(ceil(count(*) OVER () / 7) AS BIGINT) AS INT) AS part FROM documents")
def split_ceil(docs: DataFrame) -> DataFrame:
    return split_rows(docs.select("doc_id"), 7, "doc_id", ceil=True)


@query("positional_slice", "documents", "SELECT doc_id, row_no FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_no FROM documents) WHERE row_no >= 40 AND row_no < 90")
def docs_slice(docs: DataFrame) -> DataFrame:
    return positional_slice(docs.select("doc_id"), 40, 90, "doc_id")


_IDS = "(SELECT id FROM (SELECT DISTINCT id FROM raw_docs WHERE id IS NOT NULL) ORDER BY md5('0:' || id), id LIMIT 100)"


@query("sample_semijoin", "annotated raw_docs", f"SELECT id, ingest_ts, collection FROM annotated WHERE id IN (SELECT id FROM {_IDS})")
def sample_semijoin(df: DataFrame, raw: DataFrame) -> DataFrame:
    return P.restrict(df, P.sample_ids(raw, 100)).select("id", "ingest_ts", "collection")


@query("shard", "raw_docs", "SELECT id FROM raw_docs WHERE CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 5 = 0")
def shard(raw: DataFrame) -> DataFrame:
    return P.shard(raw, 0, 5).select("id")


@query("resume_antijoin", "annotated raw_docs", "SELECT id, ingest_ts FROM annotated a WHERE NOT EXISTS (SELECT 1 FROM raw_docs r WHERE r.id = a.id)")
def resume_antijoin(df: DataFrame, raw: DataFrame) -> DataFrame:
    return P.remaining(df, raw).select("id", "ingest_ts")


@query("id_check", "annotated raw_docs", "SELECT CAST(count(*) FILTER (a.id IS NOT NULL AND r.id IS NOT NULL) AS BIGINT) AS matched, CAST(count(*) FILTER (r.id IS NULL) AS BIGINT) AS left_only, CAST(count(*) FILTER (a.id IS NULL) AS BIGINT) AS right_only FROM (SELECT DISTINCT id FROM annotated) a FULL JOIN (SELECT DISTINCT id FROM raw_docs) r ON a.id = r.id")
def id_check(df: DataFrame, raw: DataFrame) -> DataFrame:
    return P.check_same_ids(df, raw)


# Labels and their vocabulary.
@query("examples_per_label", "llm_result", f"SELECT label, CAST(rank AS INT) AS rank, id, k FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY id, k) AS rank FROM {_FLAT}) WHERE rank <= 20")
def examples_per_label(results: DataFrame) -> DataFrame:
    return B.examples(_flat(results), "label", "id", "k").select("label", "rank", "id", "k")


_RAWLINES = "(SELECT unnest(content).label AS label FROM llm_result)"
_JUNK = f"lower({sql_strip('label')}) <> 'clean'"


@query("junk_labels", "llm_result", f"SELECT label, CAST(count(*) AS BIGINT) AS n FROM {_RAWLINES} WHERE {_JUNK} GROUP BY label")
def junk_labels(results: DataFrame) -> DataFrame:
    return B.vocabulary(results.select(F.explode("content").alias("c")).select("c.label"))


_VOCAB = f"(SELECT label, sum(n) AS n FROM (SELECT label, count(*) AS n FROM {_RAWLINES} WHERE {_JUNK} GROUP BY label UNION ALL SELECT label, n FROM label_vocab) GROUP BY label)"


@query("vocab_topk", "llm_result label_vocab", f"SELECT label, CAST(n AS BIGINT) AS n FROM {_VOCAB} ORDER BY n DESC, label LIMIT 10")
def vocab_topk(results: DataFrame, vocab: DataFrame) -> DataFrame:
    return B.top_labels(B.vocabulary(results.select(F.explode("content").alias("c")).select("c.label"), vocab), 10)


@query("vocab_shuffled", "label_vocab", "SELECT label, n FROM label_vocab")
def vocab_shuffled(vocab: DataFrame) -> DataFrame:
    return B.shuffled(vocab, 42)


@query("vocab_growth", "llm_result", f"WITH d AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS row_no FROM (SELECT DISTINCT id FROM {_FLAT})), f AS (SELECT label, min(row_no) AS first FROM {_FLAT} JOIN d USING (id) GROUP BY label), s AS (SELECT first // 10 + 1 AS step, count(*) AS new FROM f GROUP BY 1) SELECT CAST(step * 10 AS BIGINT) AS docs, CAST(sum(new) OVER (ORDER BY step) AS BIGINT) AS labels FROM s")
def vocab_growth(results: DataFrame) -> DataFrame:
    return B.vocabulary_growth(_flat(results), "label", "id", every=10)


@query("label_attach", "llm_result", f"SELECT id, line, CASE WHEN {sql_canonical('label')} IN {sql_in(LABELS)} THEN {sql_canonical('label')} ELSE 'Clean' END AS label, CAST(count(*) AS BIGINT) AS n FROM (SELECT id, lines[i] AS line, labels[i] AS label FROM (SELECT id, lines, labels, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc.id AS id, string_split({sql_strip('doc.text')}, {NL}) AS lines, list_transform(content, lambda c: c.label) AS labels FROM llm_result))) GROUP BY ALL")
def label_attach(results: DataFrame) -> DataFrame:
    labels = F.transform("content", lambda c: c["label"])
    out = results.select(F.col("doc.id").alias("id"), F.explode(B.attach(L.split_stripped(F.col("doc.text")), labels)).alias("c"))
    return out.groupBy("id", F.col("c.line").alias("line"), F.col("c.label").alias("label")).agg(F.count("*").alias("n"))


@query("model_round_trip", "documents", f"SELECT label, CAST(count(*) AS BIGINT) AS n FROM (SELECT {_RULE} AS label FROM (SELECT unnest(string_split({sql_strip('text')}, {NL})) AS line FROM documents WHERE text IS NOT NULL)) GROUP BY label")
def model_round_trip(docs: DataFrame) -> DataFrame:
    """Prompt, model, check, repair, attach: the labelling pipeline with the rule labeler in the model's place."""
    answered = B.run_model(B.prompts(docs, key="doc_id"), B.rule_labeler).withColumn("output", B.repaired_json("output"))
    lines = answered.select("doc_id", "batch_no", F.explode(B.attach(F.col("lines"), B.output_labels(F.col("output")))).alias("c"))
    return lines.groupBy(F.col("c.label").alias("label")).agg(F.count("*").alias("n"))


@query("label_lines_check", "llm_result", f"SELECT id, ok, third AS label_three, CAST(count(*) AS BIGINT) AS n FROM (SELECT doc.id AS id, coalesce(len(content) BETWEEN 1 AND 29, false) AS ok, content[3].label AS third FROM llm_result WHERE len(list_filter(content, lambda c: c.label IS NULL OR c.label = '')) = 0 OR content IS NULL) GROUP BY ALL")
def label_lines_check(results: DataFrame) -> DataFrame:
    """Rendered output is checked against the expected form, and a label read back from it."""
    whole = results.where(F.col("content").isNull() | ~F.exists("content", lambda c: c["label"].isNull() | (c["label"] == "")))
    rendered = F.array_join(F.transform("content", lambda c, i: F.concat(F.lit("Line "), (i + 1).cast("string"), F.lit(": "), c["label"])), "\n")
    out = whole.select(F.col("doc.id").alias("id"), F.coalesce(L.well_formed(rendered), F.lit(False)).alias("ok"), F.get("content", F.lit(2))["label"].alias("label_three"))
    return out.groupBy("id", "ok", "label_three").agg(F.count("*").alias("n"))


@query("label_after_colon", "llm_result", f"SELECT label, CAST(count(*) AS BIGINT) AS n FROM (SELECT lower({sql_strip('x')}) AS label FROM (SELECT string_split('Line 1: ' || c.label, ':')[2] AS x FROM (SELECT unnest(content) AS c FROM llm_result))) GROUP BY label")
def label_after_colon(results: DataFrame) -> DataFrame:
    lines = results.select(F.explode("content").alias("c")).select(L.label_after_colon(F.concat(F.lit("Line 1: "), F.col("c.label"))).alias("label"))
    return lines.groupBy("label").agg(F.count("*").alias("n"))


@query("model_text_cleanup", "llm_result", f"SELECT label, CAST(count(*) AS BIGINT) AS n FROM (SELECT regexp_replace(regexp_replace('```json' || c.label || '``` ', '^[ `\\njson]+', ''), '[ `\\njson]+$', '') AS label FROM (SELECT unnest(content) AS c FROM llm_result)) GROUP BY label")
def model_text_cleanup(results: DataFrame) -> DataFrame:
    lines = results.select(F.explode("content").alias("c")).select(L.model_text(F.concat(F.lit("```json"), F.col("c.label"), F.lit("``` "))).alias("label"))
    return lines.groupBy("label").agg(F.count("*").alias("n"))


@query("token_cost", "documents", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(t) AS BIGINT) AS tokens, round(sum(t * 0.15 / 1e6 + 10 * 0.6 / 1e6), 6) AS cost, round(avg(t), 4) AS mean_tokens FROM (SELECT ceil(length(text) / 4) AS t FROM documents WHERE text IS NOT NULL)")
def token_cost(docs: DataFrame) -> DataFrame:
    t = docs.where(F.col("text").isNotNull()).select(B.tokens_estimate(F.col("text")).alias("t"))
    return t.agg(F.count("*").alias("n"), F.sum("t").cast("bigint").alias("tokens"), F.round(F.sum(B.cost(F.col("t"), F.lit(10))), 6).alias("cost"), F.round(F.avg("t"), 4).alias("mean_tokens"))


_SYN = {"Navigation": "Navigation & Interface Elements", "Spam": "Promotional & Spam Content"}
_SYNSQL = "CASE label " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _SYN.items()) + " ELSE label END"


@query("synonym_map_apply", "llm_result", f"SELECT {_SYNSQL} AS label, CAST(count(*) AS BIGINT) AS n FROM {_RAWLINES} GROUP BY 1")
def synonym_map_apply(results: DataFrame) -> DataFrame:
    return A.label_frequency(results.select(F.transform(B.rewrite(F.col("content"), _SYN), lambda c: c["label"]).alias("labels")), "labels")


@query("synonym_join", "llm_result", f"SELECT {_SYNSQL} AS label, CAST(count(*) AS BIGINT) AS n FROM {_RAWLINES} GROUP BY 1")
def synonym_join(results: DataFrame) -> DataFrame:
    mapping = results.sparkSession.createDataFrame(list(_SYN.items()), "label string, name string")
    return S.apply_map(results.select(F.explode("content").alias("c")).select("c.label"), mapping).groupBy("label").agg(F.count("*").alias("n"))


@query("synonym_groups", "llm_result label_vocab", f"SELECT lower({sql_strip('label')}) AS name, string_agg(DISTINCT label, '|' ORDER BY label) AS words FROM (SELECT label FROM {_RAWLINES} WHERE label IS NOT NULL UNION ALL SELECT label FROM label_vocab) GROUP BY 1")
def synonym_groups(results: DataFrame, vocab: DataFrame) -> DataFrame:
    labels = results.select(F.explode("content").alias("c")).select("c.label").where(F.col("label").isNotNull()).unionByName(vocab.select("label"))
    groups = labels.select(F.lower(L.strip(F.col("label"))).alias("name"), F.array("label").alias("words"))
    return S.merge_groups(groups).withColumn("words", F.array_join("words", "|"))


@query("synonym_pipeline", "label_vocab")
def synonym_pipeline(vocab: DataFrame) -> DataFrame:
    return S.synonym_map(vocab.where(is_junk(F.col("label"))), 0.6)


@query("medoid", "embeddings", "WITH p AS (SELECT a.label, a.vec_id, sum(1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS d, count(*) AS n FROM embeddings a JOIN embeddings b ON a.label = b.label GROUP BY ALL) SELECT label, vec_id, round(d, 3) AS sum_distance, CAST(n AS BIGINT) AS members FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(d, 6), vec_id) AS r FROM p) WHERE r = 1")
def medoid(df: DataFrame) -> DataFrame:
    return S.medoids(df, "label", "vec_id").withColumn("sum_distance", F.round("sum_distance", 3))


@query("cluster_labels", "embeddings")
def cluster_labels(df: DataFrame) -> DataFrame:
    return S.clusters(df, "label", "vec_id", threshold=0.3)


@query("validate_json", "events", "SELECT event_type, CAST(count(*) FILTER (json_valid(props)) AS BIGINT) AS good, CAST(count(*) FILTER (NOT coalesce(json_valid(props), false)) AS BIGINT) AS bad FROM events GROUP BY event_type")
def validate_json(events: DataFrame) -> DataFrame:
    good = valid_record(parsed_record(F.col("props"), "k int"))
    return events.groupBy("event_type").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))


# Sources and sinks: what was written to the shared folder is read again and must be the table.
def round_trip(name: str, source: str, sql: str) -> Callable:
    """Registers a function of (frames..., a fresh path)."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(*(table(spark, sf_dir, t) for t in source.split()), scratch(spark))
        ORACLE[name] = sql
        return f

    return register


_PAGE = "id string, ingest_ts timestamp_ntz, text string, langs array<string>, quality_scores array<double>"


@round_trip("sink_jsonl", "annotated", f"SELECT id, ingest_ts, text, array_to_string(list_transform(langs, lambda x: coalesce(x, '-')), ' ') AS langs, CAST(len(quality_scores) AS BIGINT) AS n_scores FROM annotated")
def sink_jsonl(df: DataFrame, path: str) -> DataFrame:
    W.write_jsonl(df.select("id", "ingest_ts", "text", "langs", "quality_scores"), path)
    back = I.read_jsonl(df.sparkSession, path, _PAGE)
    return back.select("id", "ingest_ts", "text", F.array_join(F.transform("langs", lambda x: F.coalesce(x, F.lit("-"))), " ").alias("langs"), F.when(F.col("quality_scores").isNotNull(), F.size("quality_scores")).cast("bigint").alias("n_scores"))


@round_trip("sink_jsonl_gzip", "raw_docs", "SELECT id, text, u FROM raw_docs")
def sink_jsonl_gzip(df: DataFrame, path: str) -> DataFrame:
    W.write_jsonl(df.select("id", "text", "u"), path, compression="gzip")
    return I.read_jsonl(df.sparkSession, path, "id string, text string, u string")


@round_trip("sink_zstd", "documents", "SELECT doc_id, text, lang FROM documents")
def sink_zstd(docs: DataFrame, path: str) -> DataFrame:
    W.write_zstd(docs.select("doc_id", "text", "lang"), f"{path}.parquet")
    return I.read_corpus(docs.sparkSession, f"{path}.parquet")


@round_trip("source_directory", "documents", "SELECT doc_id, text FROM documents")
def source_directory(docs: DataFrame, path: str) -> DataFrame:
    """Files *.jsonl in folders within folders."""
    W.write_jsonl(docs.select("doc_id", "text"), f"{path}/a/b")
    return docs.sparkSession.read.schema("doc_id bigint, text string").option("recursiveFileLookup", True).json(path, pathGlobFilter="*.json")


@round_trip("source_lossy", "documents", "SELECT doc_id, replace(text, chr(65533), '') AS text FROM documents WHERE text IS NOT NULL")
def source_lossy(docs: DataFrame, path: str) -> DataFrame:
    W.write_jsonl(docs.where(F.col("text").isNotNull()).select("doc_id", "text"), path)
    return I.read_jsonl_lossy(docs.sparkSession, path, "doc_id bigint, text string")


@round_trip("source_lenient", "raw_docs", "SELECT id, 'a' || chr(9) || 'b' || chr(1) AS text FROM raw_docs WHERE id IS NOT NULL")
def source_lenient(raw: DataFrame, path: str) -> DataFrame:
    """Records with raw control characters within their strings."""
    line = F.concat(F.lit('{"id": '), F.to_json(F.struct("id")).substr(F.lit(7), F.length(F.to_json(F.struct("id"))) - 7), F.lit(', "text": "a\tb\x01"}'))
    raw.where(F.col("id").isNotNull()).select(line.alias("value")).write.text(path)
    return I.read_jsonl(raw.sparkSession, path, "id string, text string", lenient=True)


@round_trip("source_lines", "documents", f"SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split_regex(text, '\\r\\n|[\\r\\n]')) AS x FROM documents WHERE text IS NOT NULL) WHERE {sql_strip('x')} <> ''")
def source_lines(docs: DataFrame, path: str) -> DataFrame:
    docs.where(F.col("text").isNotNull()).select("text").write.text(path)
    return I.read_lines(docs.sparkSession, path).agg(F.count("*").alias("n"))


@round_trip("source_first", "documents", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100")
def source_first(docs: DataFrame, path: str) -> DataFrame:
    """The first hundred rows of a scan of one ordered file."""
    docs.select("doc_id").orderBy("doc_id").coalesce(1).write.json(path)
    return I.read_first(I.read_jsonl(docs.sparkSession, path, "doc_id bigint"), 100)


@round_trip("source_files", "documents", "SELECT 'part=' || CAST(unnest(range(0, 7)) AS VARCHAR) AS name")
def source_files(docs: DataFrame, path: str) -> DataFrame:
    """Folders of parts by prefix, in order."""
    W.write_parts(docs.select("doc_id"), path, 7, "doc_id")
    return docs.sparkSession.createDataFrame([(n,) for n in I.files(docs.sparkSession, path, "part=", folders=True)], "name string")


@round_trip("sink_parts", "documents", "SELECT doc_id, CAST(ntile(7) OVER (ORDER BY doc_id) - 1 AS INT) AS part FROM documents")
def sink_parts(docs: DataFrame, path: str) -> DataFrame:
    W.write_parts(docs.select("doc_id"), path, 7, "doc_id")
    return docs.sparkSession.read.schema("doc_id bigint, part int").json(path)


@round_trip("sink_concatenate", "documents", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(doc_id) AS BIGINT) AS total FROM documents")
def sink_concatenate(docs: DataFrame, path: str) -> DataFrame:
    spark = docs.sparkSession
    W.write_jsonl(docs.select("doc_id"), path)
    W.concatenate(spark, [f"{path}/{n}" for n in I.files(spark, path, ending=".json")], f"{path}-all")
    return I.read_jsonl(spark, f"{path}-all", "doc_id bigint").agg(F.count("*").alias("n"), F.sum("doc_id").alias("total"))


@round_trip("sink_csv", "doc_pred", "SELECT text, nemotron_label, hplt_doc_score FROM doc_pred WHERE text <> ''")
def sink_csv(pred: DataFrame, path: str) -> DataFrame:
    W.write_csv(pred.where(F.col("text") != "").select("text", "nemotron_label", "hplt_doc_score"), path)
    return I.read_predictions(pred.sparkSession, path)


@round_trip("sink_vocabulary", "label_vocab", "SELECT label, n FROM label_vocab")
def sink_vocabulary(vocab: DataFrame, path: str) -> DataFrame:
    W.write_vocabulary(vocab, path)
    return I.read_vocabulary(vocab.sparkSession, path)


@round_trip("sink_salvaged", "annotated", "SELECT id, text FROM annotated WHERE text <> '' AND robotstxt = 'allowed'")
def sink_salvaged(df: DataFrame, path: str) -> DataFrame:
    W.write_salvaged(df.select("id", "text", "robotstxt"), path)
    return I.read_jsonl(df.sparkSession, path, "id string, text string")


@round_trip("sink_splits", "llm_result", f"SELECT label, split, CAST(count(*) AS BIGINT) AS n FROM (SELECT label, CASE WHEN (r - 1) * 100 < n * 70 THEN 'train' WHEN (r - 1) * 100 < n * 85 THEN 'validation' ELSE 'test' END AS split FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_KEY}, id, k, text) AS r, count(*) OVER (PARTITION BY label) AS n FROM {_FLAT})) GROUP BY ALL")
def sink_splits(results: DataFrame, path: str) -> DataFrame:
    """Splits and the map of classes are written and read again; rows come back under their class."""
    spark = results.sparkSession
    data = T.encode(T.stratified_split(_flat(results), key=("id", "k", "text")))
    W.write_splits(data.select("text", "code", "split"), path, T.label_map(data))
    classes = spark.read.schema("label string, code int").json(f"{path}/classes")
    return spark.read.parquet(f"{path}/data").join(F.broadcast(classes), "code").groupBy("label", "split").agg(F.count("*").alias("n"))


@round_trip("sink_settings", "region", "SELECT CAST(0.8 AS DOUBLE) AS threshold, 'trim' AS mode")
def sink_settings(region: DataFrame, path: str) -> DataFrame:
    W.write_settings(region.sparkSession, path, threshold=0.8, mode="trim")
    return region.sparkSession.read.schema("threshold double, mode string").json(path)


@round_trip("sink_eval", "annotated", f"WITH {_REPORT}, m AS (SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(hit) / sum(support), 6) AS accuracy FROM s) SELECT unnest(['Test set evaluation results:', 'n: ' || n, 'accuracy: ' || accuracy]) AS value FROM m")
def sink_eval(df: DataFrame, path: str) -> DataFrame:
    metrics = A.classification_metrics(_guesses(df)).select("n", F.round("accuracy", 6).alias("accuracy"))
    W.write_eval(metrics, path)
    return df.sparkSession.read.text(path)


@round_trip("source_validated", "scored", f"SELECT CAST(count(*) FILTER (v IS NOT NULL) AS BIGINT) AS good, CAST(count(*) FILTER (v IS NULL) AS BIGINT) AS bad FROM (SELECT {_NUMBERS} AS v FROM (SELECT {_TUPLE} AS t FROM scored))")
def source_validated(df: DataFrame, path: str) -> DataFrame:
    W.write_jsonl(df, path)
    good, bad = I.read_validated(df.sparkSession, path, "id string, text string, line_quality string")
    return good.agg(F.count("*").alias("good")).crossJoin(bad.agg(F.count("*").alias("bad")))


# Salvage with classification on the way; the rules stand for the model.
_RULED_LINES = Z.replace("'label': line_quality_labels[i]", "'label': " + _RULE.replace("(line", "(lines[i]"))
QUERIES["salvage_classified"] = lambda s, d: counted(lambda df: Q.salvage_classified(df.drop(*Q.PARALLEL), R.rule_model, "trim"))(table(s, d, "annotated"))
ORACLE["salvage_classified"] = sql_mask(_CLEAN, "trim", where=_WEAK, after="length(text) >= 250").replace(Z, _RULED_LINES)


def by_first_word() -> Callable[[list[str]], list[str]]:
    """Stands in for a reviewer: unites the labels of a question by their first word."""
    import json
    import re

    def answer(prompt: str) -> str:
        groups: dict[str, list[str]] = {}
        for label in re.search(r"same: (.*)\.\n", prompt).group(1).split(", "):
            groups.setdefault(label.split(" ")[0].lower(), []).append(label)
        return "Sure:\n" + json.dumps(groups)

    return lambda prompts: [answer(p) for p in prompts]


@query("synonym_review", "label_vocab", "SELECT name, string_agg(DISTINCT label, '|' ORDER BY label) AS words FROM (SELECT CASE WHEN count(*) OVER (PARTITION BY lower(label[1])) > 1 THEN lower(string_split(label, ' ')[1]) ELSE lower(label[1]) END AS name, label FROM (SELECT DISTINCT label FROM label_vocab WHERE label NOT LIKE '%,%')) GROUP BY name")
def synonym_review(vocab: DataFrame) -> DataFrame:
    """Groups by first letter, split by a reviewer into groups by first word; single labels are not asked about."""
    labels = vocab.where(~F.col("label").contains(",")).select("label").distinct()
    groups = labels.groupBy(F.lower(F.substring("label", 1, 1)).alias("name")).agg(F.array_sort(F.collect_set("label")).alias("words"))
    return S.review(groups, by_first_word).withColumn("words", F.array_join("words", "|"))


@query("synonym_merge", "llm_result label_vocab")
def synonym_merge(results: DataFrame, vocab: DataFrame) -> DataFrame:
    """Labels of a run and of its own earlier results after clustering, review and rewriting."""
    now, before, _ = S.merge_synonyms(results, results, vocab, by_first_word)
    lines = lambda df: df.select(F.explode("content").alias("c")).select("c.label")
    return lines(now).unionByName(lines(before)).groupBy("label").agg(F.count("*").alias("n"))


@query("trained_classifier", "llm_result")
def trained_classifier(results: DataFrame) -> DataFrame:
    """Weighted, smoothed loss, evaluation on the way, the best model by validation loss; measured on the test split."""
    data = T.encode(T.stratified_split(_flat(results), key=("id", "k", "text")))
    train = data.where(F.col("split") == "train")
    codes = {r["code"]: r["weight"] for r in A.class_weights(train.select(F.col("code").alias("label"))).select(F.col("label").alias("code"), "weight").collect()}
    model = T.train_classifier(train, data.where(F.col("split") == "validation"), len(LABELS), codes)
    return A.classification_metrics(model.predict(data.where(F.col("split") == "test").select("text", F.col("code").alias("truth"))))
