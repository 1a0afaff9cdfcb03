"""Missing-value rules as column expressions.

One missing marker is used throughout: SQL NULL.  NaN never enters a column,
because Spark sorts and aggregates NaN as an ordinary (largest) value.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_ignoring(c: Column | str) -> Column:
    """Grouped sum that skips missing values; an all-missing group sums to 0."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))


def sum_poisoning(c: Column | str) -> Column:
    """Grouped sum that is missing as soon as one input is missing."""
    return F.when(F.count(_col(c)) == F.count(F.lit(1)), F.sum(_col(c)))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division whose result is NULL for any zero denominator.

    0/0 and x/0 are both NULL: an infinity would wipe out the whole
    standardised feature downstream.
    """
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def not_in_keeping_null(c: Column | str, values: Iterable[object]) -> Column:
    """``NOT IN`` under which a missing value passes the filter."""
    return ~F.coalesce(_col(c).isin(list(values)), F.lit(False))


def lenient_int(c: Column | str, default: int | None = None) -> Column:
    """Text to whole number, truncating decimals; unreadable text gives ``default``."""
    parsed = _col(c).try_cast("double").try_cast("int")
    return parsed if default is None else F.coalesce(parsed, F.lit(default))


def weight_where_present(value: Column | str, weight: Column | str) -> Column:
    """The weight, but only where the value it weighs is known."""
    return F.when(_col(value).isNotNull(), _col(weight))


def rowwise_sum(columns: Iterable[Column | str]) -> Column:
    """Sum across the columns of one row, skipping missing ones."""
    parts = [F.coalesce(_col(c).cast("double"), F.lit(0.0)) for c in columns]
    return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def only_value(c: Column | str, what: str) -> Column:
    """The single value of a group; the job fails if the group has several rows."""
    message = F.lit(f"duplicate key while reshaping {what}")
    return F.when(F.count(F.lit(1)) > 1, F.raise_error(message)).otherwise(F.max(_col(c)))
