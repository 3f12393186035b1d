"""One operator for all line filters: keep lines by a predicate, or trim both ends by it, over parallel arrays at once.

No shuffle and no Python: every form is a projection, fused with the scan by whole-stage code generation.
Edge cases: a null text gives a null text; arrays that are null or of another length are cut or padded with nulls to the lines;
columns of the frame outside ``arrays`` pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lines import join_lines, let, split_lines

MODES = ("filter", "trim")


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return mode


def masked(zipped: Column, keep: Callable[[Column], Column], mode: str) -> Column:
    """The structs of ``zipped`` that stay. A predicate that is null counts as false."""
    holds = lambda z: F.coalesce(keep(z), F.lit(False))
    if check_mode(mode) == "filter":
        return F.filter(zipped, holds)

    def bounds(z: Column) -> Column:
        flags = F.transform(z, holds)
        ends = lambda f: F.struct(F.array_position(f, True).cast("int").alias("first"), F.array_position(F.reverse(f), True).cast("int").alias("back"), F.size(f).alias("n"))
        return let(let(flags, ends), lambda e: F.when(e["first"] > 0, F.slice(z, e["first"], e["n"] - e["back"] - e["first"] + 2)).otherwise(F.slice(z, 1, 0)))

    return let(zipped, bounds)


def mask(
    df: DataFrame,
    arrays: list[str],
    keep: Callable[[Column], Column],
    mode: str = "filter",
    text: str = "text",
    split: Callable[[Column], Column] = split_lines,
    strict: bool = False,
    leave: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Rewrites ``text`` and ``arrays`` to the lines that stay; ``keep`` sees ``line`` and the entries of the arrays.

    ``strict`` raises where an array's length differs from the number of lines. ``leave`` tells from the new text which rows are left: it is
    asked inside a generator of none or one row, so that the optimizer can't put a copy of the whole mask into a filter.
    """
    lines = split(F.col(text))
    if strict:
        bad = F.lit(False)
        for name in arrays:
            bad = bad | (F.size(F.col(name)) != F.size(lines))
        lines = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit("array length differs from the number of lines"))).otherwise(lines)
    # arrays_zip takes each array once; get() inside a lambda would evaluate a computed array again for every line
    names = {"line": "0"} | {name: str(i + 1) for i, name in enumerate(arrays)}
    present = [F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType)) for name in arrays]
    sides = F.struct(*(c.alias(str(i)) for i, c in enumerate([lines, *present])))
    zipped = let(sides, lambda s: F.slice(F.arrays_zip(*(s[str(i)] for i in range(len(present) + 1))), 1, F.size(s["0"])))

    class Named:
        def __init__(self, z: Column):
            self.z = z

        def __getitem__(self, name: str) -> Column:
            return self.z[names[name]]

    def rewritten(k: Column) -> Column:
        made = [F.when(F.col(text).isNotNull(), join_lines(k["0"])).alias(text)]
        made += [F.when(F.col(name).isNotNull() & F.col(text).isNotNull(), k[names[name]]).otherwise(F.col(name)).alias(name) for name in arrays]
        return F.struct(*made)

    row = let(masked(zipped, lambda z: keep(Named(z)), mode), rewritten)
    one = row if leave is None else F.explode(F.filter(F.array(row), lambda r: F.coalesce(leave(r[text]), F.lit(False))))
    return df.withColumn("__row", one).withColumns({c: F.col(f"__row.{c}") for c in (text, *arrays)}).drop("__row")
