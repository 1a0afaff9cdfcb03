"""Text formatting for reports and map popups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shown(c: Column) -> Column:
    """Text of a value, with the missing marker spelled out."""
    return F.coalesce(c.cast("string"), F.lit("NA"))


def thousands(c: Column) -> Column:
    """Whole number with comma separators."""
    return F.format_number(c.cast("double"), 0)


def count_and_rate(part: Column, whole: Column) -> Column:
    """The removed-rows line: a count and its percentage with two decimals."""
    percent = F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))
    return F.format_string("Rows removed: %d (%.2f%%)", part, percent)
