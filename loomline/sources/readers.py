"""JSONL (plain, zstd), Parquet, CSV and TSV readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lines import score_list, strip
from ..schema import DOC_PRED, RAW, VOCAB


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str = RAW, lenient: bool = False) -> DataFrame:
    """JSONL or JSONL.zst, read strictly: a bad record fails the job; blank lines are skipped. ``lenient`` allows raw control characters."""
    return spark.read.schema(schema).json(path, mode="FAILFAST", allowUnquotedControlChars=lenient)


def read_jsonl_lossy(spark: SparkSession, path: str | list[str], schema: str = RAW) -> DataFrame:
    """JSONL whose undecodable UTF-8 bytes are dropped (genuine U+FFFD too)."""
    lines = spark.read.text(path).where(strip(F.col("value")) != "")
    text = F.regexp_replace(F.make_valid_utf8("value"), "�", "")
    return lines.select(F.from_json(text, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_corpus(spark: SparkSession, path: str, schema: str = RAW, partitions: int | None = None) -> DataFrame:
    """By ending: .jsonl, .jsonl.zst, .parquet; others raise ValueError. A zstd file is one task, so ``partitions`` spreads its rows."""
    name = path.rstrip("/")
    if name.endswith((".jsonl", ".jsonl.zst", ".zst")):
        df = read_jsonl(spark, path, schema)
    elif name.endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"no reader for {path}")
    return df.repartition(partitions) if partitions else df


def read_directory(spark: SparkSession, path: str, schema: str = RAW, recursive: bool = False) -> DataFrame:
    """All *.jsonl of a directory (or one file); an empty input raises ValueError."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", recursive)
    df = reader.json(path) if path.endswith(".jsonl") else reader.json(path, pathGlobFilter="*.jsonl")
    if df.isEmpty():
        raise ValueError(f"nothing to read in {path}")
    return df


def read_first(df: DataFrame, rows: int) -> DataFrame:
    """The first rows of a scan, in order of file and place; -1 means all. A limit is this reader's purpose: it ends the scan early."""
    return df if rows == -1 else df.limit(rows)


def files(spark: SparkSession, path: str, prefix: str = "", ending: str = "", folders: bool = False) -> list[str]:
    """Names of the files (or folders) of a folder by prefix and ending, in order."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    names = [f.getPath().getName() for f in found if f.isFile() != folders]
    return sorted(n for n in names if n.startswith(prefix) and n.endswith(ending) and n[0] not in "._")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines of text files, with the file each comes from."""
    return spark.read.text(path).where(strip(F.col("value")) != "").select("value", F.col("_metadata.file_path").alias("file"))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=VOCAB)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header whose texts may hold newlines and doubled quotes."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', schema=DOC_PRED)


def read_validated(spark: SparkSession, path: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) records of JSONL. Bad are those that don't parse or whose line_quality is missing or malformed; they come as raw text."""
    raw = spark.read.text(path).where(strip(F.col("value")) != "")
    parsed = raw.select("value", parsed_record(F.col("value"), schema).alias("r"))
    good = valid_record(F.col("r")) & F.coalesce(score_list(F.col("r.line_quality")).isNotNull(), F.lit(False))
    return parsed.where(good).select("r.*").drop("_corrupt"), parsed.where(~good).select("value")


def parsed_record(text: Column, schema: str) -> Column:
    """A JSON record leniently read; ``_corrupt`` holds the text of one that doesn't parse."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowUnquotedControlChars": "true"}
    return F.from_json(text, f"{schema}, _corrupt string", options)


def valid_record(record: Column) -> Column:
    return F.coalesce(record.isNotNull() & record["_corrupt"].isNull(), F.lit(False))
