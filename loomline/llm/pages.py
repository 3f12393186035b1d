"""What the operators share: valid rows, bounded samples of labelled rows, running numpy code over Arrow batches."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def latest(df: DataFrame, *payload: str, key: str = "id", when: str = "ingest_ts") -> DataFrame:
    """The valid row of each id: the one of latest ``when`` (nulls first), ties by the greatest payload, so that it never varies.

    One aggregation combined on the map side; rows of a repeated id collapse before the shuffle. Null ids are left out.
    """
    rows = df.where(F.col(key).isNotNull())
    best = rows.groupBy(key).agg(F.max(F.struct(when, *payload)).alias("__best"))
    return best.select(key, *(F.col(f"__best.{c}").alias(c) for c in payload))


BUCKETS = 1 << 20


def uniform(*columns: str, seed: int = 7) -> Column:
    """A number in 0..1 by hash of the columns: the same for the same row, and apart for rows whose key repeats or is null."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(BUCKETS)) / F.lit(BUCKETS)


def share_of(rows: int, total: int) -> float:
    return min(1.0, rows / max(1, total))


def sample_pages(df: DataFrame, columns: list[str], rows: int, total: int, key: str = "id", seed: int = 7) -> list:
    """About ``rows`` of ``total`` rows, never more, chosen by hash of the key and the first column, for fitting a model on the driver.

    One pass; those of least hash stay where the share drew too many, so that the sample is always the same.
    """
    drawn = F.xxhash64(F.lit(seed), key, columns[0])
    chosen = df.where(F.pmod(drawn, F.lit(BUCKETS)) < F.lit(int(share_of(rows, total) * BUCKETS) + 1))
    return chosen.select(*columns, drawn.alias("__drawn")).orderBy("__drawn", columns[0]).limit(rows).drop("__drawn").collect()


def run(df: DataFrame, work: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, rows: int = 1024) -> DataFrame:
    """``df`` through ``work()(batch)`` in Arrow, at most ``rows`` rows at once; ``work`` is called once per task."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = work()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield f(batch.slice(start, rows))

    return df.mapInArrow(each, schema)


def annotate(df: DataFrame, work: Callable[[], Callable[[list[str | None]], list[list]]], added: str, text: str = "text", rows: int = 512) -> DataFrame:
    """``df`` with the columns ``added`` (DDL) that ``work()(texts)`` gives as lists, in place of ``text``.

    The other columns pass through as they are; names must differ from the added ones.
    """
    passed = [c for c in df.columns if c != text]
    fields = StructType.fromDDL(added)
    kinds = list(to_arrow_schema(fields))
    schema = StructType([*(df.schema[c] for c in passed), *fields])

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        f = work()

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = f(batch.column(text).to_pylist())
            arrays = [pa.array(values, type=k.type) for values, k in zip(made, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), *arrays], names=[*passed, *(k.name for k in kinds)])

        return each

    return run(spread(df.select(*passed, text)), start, schema, rows)


def spread(df: DataFrame) -> DataFrame:
    """Enough partitions for all cores: a few compressed files hold minutes of Python work. Where a table comes in fewer splits than
    twice the cores, its rows are dealt out again; a larger one is read as it lies."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(4 * cores) if df.rdd.getNumPartitions() < 2 * cores else df


def save_model(spark: SparkSession, model: object, path: str) -> None:
    """A fitted model, of any of the operators, as one row of bytes on the shared file system, to be used by later runs instead of fitting."""
    spark.createDataFrame([(pickle.dumps(model),)], "model binary").coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> object:
    """A saved model. Only files that this library wrote are to be read: they are pickles."""
    return pickle.loads(spark.read.parquet(path).first()["model"])


class Bounded(dict):
    """A memory of results that starts afresh when it holds too many."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()
