"""Labels as Catalyst expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import CLEAN, LABELS, LANGUAGE_OF_CODE
from .lines import strip


def lookup(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(table.items())))


def canonical(label: Column) -> Column:
    """One of the nine labels whatever its case and outer blanks; other labels and null stay as they are."""
    return F.coalesce(F.element_at(lookup({x.lower(): x for x in LABELS}), F.lower(strip(label))), label)


def repaired(label: Column) -> Column:
    """Labels outside the nine, and null, become Clean."""
    known = canonical(label)
    return F.when(known.isin(LABELS), known).otherwise(F.lit(CLEAN))


def is_junk(label: Column) -> Column:
    """Not clean, whatever the case and outer blanks; null is no junk."""
    return F.coalesce(F.lower(strip(label)) != "clean", F.lit(False))


def language_name(code: Column, strict: bool = True) -> Column:
    """Name of a language code; an unknown one raises, or gives null when not strict. Null stays null."""
    name = F.element_at(lookup(LANGUAGE_OF_CODE), code)
    if not strict:
        return name
    return F.when(code.isNull() | name.isNotNull(), name).otherwise(F.raise_error(F.concat(F.lit("unknown language code "), code)))
