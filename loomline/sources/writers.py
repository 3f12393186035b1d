"""JSONL, TSV, CSV and Parquet writers; splitting and concatenating files."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import part_ceil, part_even, with_row_number
from ..operators.quality import allowed


def write_jsonl(df: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    """One JSON object per row, null fields kept, non-ASCII as it is, timestamps in ISO form."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    df.write.mode(mode).options(ignoreNullFields=False, timestampFormat=iso, timestampNTZFormat=iso).json(path, compression=compression)


def write_salvaged(df: DataFrame, path: str, mode: str = "append") -> None:
    """Only pages with text whose robots.txt allows it."""
    write_jsonl(allowed(df), path, mode)


def write_vocabulary(vocab: DataFrame, path: str) -> None:
    """TSV, most frequent first, one file: a vocabulary is small."""
    vocab.select("label", "n").orderBy(F.desc("n"), "label").coalesce(1).write.mode("overwrite").csv(path, sep="\t")


def write_splits(df: DataFrame, path: str, classes: DataFrame) -> None:
    """Parquet partitioned by split, the class codes beside it."""
    df.write.mode("overwrite").partitionBy("split").parquet(f"{path}/data")
    classes.coalesce(1).write.mode("overwrite").json(f"{path}/classes")


def write_zstd(df: DataFrame, path: str) -> None:
    """A corpus compressed with zstd: Parquet, as Spark writes no zstd JSON."""
    df.write.mode("overwrite").parquet(path, compression="zstd")


def write_eval(metrics: DataFrame, path: str, title: str = "Test set evaluation results:") -> None:
    """A one-row frame of metrics as text: a title, then ``name: value`` lines."""
    pairs = F.array(F.lit(title), *(F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in metrics.columns))
    metrics.select(F.explode(pairs).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_settings(spark: SparkSession, path: str, **settings: object) -> None:
    """A one-row JSON sidecar of a run's settings."""
    spark.createDataFrame([(json.dumps(settings, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def base_name(path: str) -> str:
    """A file's name without .jsonl or .jsonl.zst."""
    return re.sub(r"\.jsonl(\.zst)?$", "", path.rstrip("/").rpartition("/")[2])


def plain_name(path: str) -> str:
    """Output is plain unless a codec is asked for: the name loses .zst."""
    return path.removesuffix(".zst")


def split_rows(df: DataFrame, parts: int, *order: str, ceil: bool = False) -> DataFrame:
    """Adds ``part``: contiguous parts of the order, near-equal (no empty one) or of ceil(n / parts) rows."""
    if parts < 1:
        raise ValueError("parts must be positive")
    numbered = with_row_number(df, *order)
    total = numbered.count()
    rule = part_ceil if ceil else part_even
    return numbered.withColumn("part", rule(F.col("row_no"), total, parts)).drop("row_no")


def write_parts(df: DataFrame, path: str, parts: int, *order: str, ceil: bool = False) -> None:
    split_rows(df, parts, *order, ceil=ceil).write.mode("overwrite").partitionBy("part").option("ignoreNullFields", False).json(path)


def concatenate(spark: SparkSession, paths: list[str], out: str) -> None:
    """Text files one after another in order of name, as one file; the last line of a file without newline stays apart from the next.

    One file is the purpose, so one task writes it, a file's buffer at a time through the Hadoop file system: nothing is shuffled or held.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(out)
    target = folder.getFileSystem(conf)
    target.mkdirs(folder)
    sink = target.create(jvm.org.apache.hadoop.fs.Path(folder, "part-00000.txt"), True)
    try:
        for name in sorted(paths, key=lambda p: p.rpartition("/")[2]):
            path = jvm.org.apache.hadoop.fs.Path(name)
            source = path.getFileSystem(conf)
            length = source.getFileStatus(path).getLen()
            if not length:
                continue
            stream = source.open(path)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, sink, 1 << 20, False)
            stream.seek(length - 1)
            if stream.read() != 10:
                sink.write(10)
            stream.close()
    finally:
        sink.close()
