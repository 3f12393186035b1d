"""Row numbers over a total order without drawing all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def with_row_number(df: DataFrame, *order: Column | str, name: str = "row_no") -> DataFrame:
    """Adds the position (from 0) of each row in the order. Ties are broken arbitrarily but once: the sorted rows are written.

    One range-partitioned sort; the only thing gathered is a count per partition.
    """
    low = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    part = F.shiftright("__id", 33).cast("int")
    sorted_once = checkpointed(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()))
    counts = {r["part"]: r["n"] for r in sorted_once.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    start, offsets = 0, [0] * (max(counts, default=0) + 1)
    for k in range(len(offsets)):
        offsets[k] = start
        start += counts.get(k, 0)
    before = F.get(F.lit(offsets).cast("array<bigint>"), part)
    return sorted_once.withColumn(name, low + before).drop("__id")


def part_even(row: Column, total: int, parts: int) -> Column:
    """The part of at most ``parts`` near-equal contiguous ones that holds position ``row``; the first ones take one more."""
    short, longer = divmod(total, parts)
    head = longer * (short + 1)
    tail = F.lit(longer) + F.floor((row - head) / max(short, 1))
    return F.when(row < head, F.floor(row / (short + 1))).otherwise(tail).cast("int")


def part_ceil(row: Column, total: int, parts: int) -> Column:
    """Parts of ceil(total / parts) rows each; the last is short and there may be fewer."""
    return F.floor(row / max(1, -(-total // parts))).cast("int")


def positional_slice(df: DataFrame, start: int, stop: int | None, *order: Column | str) -> DataFrame:
    """Rows at positions start to stop - 1 of the order; a stop of None or -1 means all."""
    numbered = with_row_number(df, *order)
    out = numbered.where(F.col("row_no") >= start)
    return out if stop in (None, -1) else out.where(F.col("row_no") < stop)
