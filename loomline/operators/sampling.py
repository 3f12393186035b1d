"""Sampling, sharding, semi- and anti-joins on ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small


def sample_ids(df: DataFrame, k: int, key: str = "id", seed: int = 0) -> DataFrame:
    """k different ids, the same ones each time: those of least md5. A sampling operator, so the limit is its purpose."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(k)


def restrict(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return df.join(broadcast_if_small(ids.select(key)), key, "left_semi")


def remaining(df: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id has no output yet. Null ids always remain."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def shard(df: DataFrame, index: int, count: int, key: str = "id") -> DataFrame:
    """One of ``count`` disjoint shards by hash of the key."""
    if not 0 <= index < count:
        raise ValueError("index must be in 0..count-1")
    return df.where(F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(count)) == index)


def check_same_ids(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """(matched, left_only, right_only): what joining two outputs by id meets; replaces joining by position."""
    a, b = (x.select(key).distinct() for x in (left, right))
    both = a.withColumn("l", F.lit(1)).join(b.withColumn("r", F.lit(1)), key, "full")
    return both.agg(
        F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("matched"),
        F.count_if(F.col("r").isNull()).alias("left_only"),
        F.count_if(F.col("l").isNull()).alias("right_only"),
    )
