"""What depends on the session: durable cuts of a lineage, and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a lookup side is broadcast; beyond it the plain join is left to Catalyst.
BROADCAST_ROWS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir rules. Where it is unset, one is made in local mode only, which is one machine."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="loomline-checkpoint-")
        context.setCheckpointDir(shared)
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the reliable checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def scratch(spark: SparkSession) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint when ``df`` has at most ``rows`` rows (a limited count finds out), else ``df`` itself."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
