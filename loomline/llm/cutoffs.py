"""Score cutoffs that keep a target share of each source's records.

Iterative histogram refinement: the scores of a source are counted into equal bins between its least and greatest score, the bin that holds
the target rank becomes the new range, and so on until the range is one value. Bins carry the least and greatest score that fell into them,
so ranges are always occurring scores and the result is exact: as the bin number never falls while the score rises, all scores between a
bin's least and greatest lie in that bin.

Nulls, NaN and scores outside 0..1 are no records. Sources without target, and targets without records, give no row. Ties at the cutoff are
all kept. A null source or target is left out. Columns beside those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lines import strip
from ..session import broadcast_if_small, checkpointed

BINS = 4096


def source_name(collection: Column) -> Column:
    """Sources are compared in lower case without outer blanks."""
    return F.lower(strip(collection))


def cutoffs(records: DataFrame, targets: DataFrame, source: str = "source", scores: str = "scores", per_cent: str = "target_pct", bins: int = BINS) -> DataFrame:
    """(source, cutoff, kept, total) from arrays of scores per record and one target per source.

    Each round is one pass with partial aggregation by (source, bin); nothing but counts per bin is shuffled, whatever the size of a source.
    """
    usable = F.filter(F.col(scores), lambda s: s.isNotNull() & ~F.isnan(s) & s.between(0, 1))
    goals = targets.where(F.col(source).isNotNull() & F.col(per_cent).isNotNull()).groupBy(source).agg(F.max(per_cent).alias("pct"))
    base = records.where(F.size(scores) > 0).select(source, usable.alias("s"))
    base = checkpointed(base.where(F.size("s") > 0).join(broadcast_if_small(goals.select(source)), source, "left_semi"))
    ends = base.groupBy(source).agg(F.min(F.array_min("s")).alias("lo"), F.max(F.array_max("s")).alias("hi"), F.sum(F.size("s")).alias("total"))
    # above: records over the range; wanted: the least number of records to keep, at least one
    state = ends.join(goals, source).withColumns({"above": F.lit(0).cast("bigint"), "wanted": F.greatest(F.lit(1), F.ceil(F.col("pct") * F.col("total") / 100)).cast("bigint")})
    state = checkpointed(state.withColumn("kept", F.when(F.col("lo") == F.col("hi"), F.col("total"))))
    while not state.where(F.col("lo") < F.col("hi")).isEmpty():
        open_ = state.where(F.col("lo") < F.col("hi"))
        within = base.join(broadcast_if_small(open_.select(source, "lo", "hi")), source)
        inside = within.select(source, "lo", "hi", F.explode(F.filter("s", lambda s: (s >= F.col("lo")) & (s <= F.col("hi")))).alias("s"))
        bin_ = F.least(F.lit(bins - 1), F.floor((F.col("s") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)).cast("int")
        counts = inside.groupBy(source, bin_.alias("bin")).agg(F.count("*").alias("n"), F.min("s").alias("least"), F.max("s").alias("most"))
        over = Window.partitionBy(source).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = counts.join(broadcast_if_small(open_.select(source, "total", "pct", "above", "wanted")), source).withColumn("down", F.col("above") + F.sum("n").over(over))
        hit = ranked.where((F.col("down") >= F.col("wanted")) & (F.col("down") - F.col("n") < F.col("wanted")))
        new = hit.select(
            source, F.col("least").alias("lo"), F.col("most").alias("hi"), "total", "pct", (F.col("down") - F.col("n")).alias("above"), "wanted",
            F.when(F.col("least") == F.col("most"), F.col("down")).alias("kept"),
        )
        state = checkpointed(state.where(F.col("lo") == F.col("hi")).unionByName(new.select(*state.columns)))
    return state.select(source, F.col("lo").alias("cutoff"), "kept", "total")
