"""Incremental runs over a growing folder: the checkpoint is the offset, so nothing is done twice and nothing is left out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.labeling import vocabulary
from ..operators.sampling import remaining
from ..schema import RAW


def process_new(spark: SparkSession, source: str, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], schema: str = RAW) -> StreamingQuery:
    """Runs ``transform`` over the JSONL files that came since the last run and appends the result; ends when all are read."""
    stream = spark.readStream.schema(schema).json(source)
    query = transform(stream).writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def resume(df: DataFrame, done: DataFrame, transform: Callable[[DataFrame], DataFrame], key: str = "id") -> DataFrame:
    """``transform`` of the rows without output yet. Rows that the transform drops have none and are seen again, but never come out twice."""
    return transform(remaining(df, done, key))


def grow_vocabulary(spark: SparkSession, source: str, checkpoint: str, schema: str, label_lines: Callable[[DataFrame, DataFrame], DataFrame], vocab: DataFrame, save: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Labels each micro-batch with the vocabulary as it stood before it; feedback comes per batch, not per document.

    ``label_lines(batch, vocabulary)`` gives rows with ``label``; ``save`` persists a vocabulary and gives it back as read.
    """
    state = {"vocab": vocab}

    def step(batch: DataFrame, _: int) -> None:
        state["vocab"] = save(vocabulary(label_lines(batch, state["vocab"]), state["vocab"]))

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(source)
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return state["vocab"]
