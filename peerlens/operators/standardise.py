"""Centre and scale features, with explicit rules for missing and constant ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlens.functions.columns import quoted


STATS = "__stats"


def _statistics(df: DataFrame, columns: Sequence[str]) -> Column:
    """Means and sample deviations of all columns as one scalar subquery.

    One aggregate pass yields a single row; a constant (or single-valued)
    column has no deviation; min = max is tested as well as deviation = 0,
    because a rounded mean can leave a constant column a tiny deviation.  The
    caller attaches the result as one column, so the subquery is planned once
    however many features there are.
    """
    names = [f"double({quoted(c)})" for c in columns]
    means = ", ".join(f"avg({c})" for c in names)
    scales = ", ".join(f"CASE WHEN min({c}) <> max({c}) THEN nullif(stddev_samp({c}), 0D) END" for c in names)
    return df.agg(F.expr(f"named_struct('mean', array({means}), 'scale', array({scales}))").alias("s")).scalar()


def statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``(s)``: the means and scales that ``standardise`` can be given later on."""
    return df.sparkSession.range(1).select(_statistics(df, columns).alias("s"))


def standardise(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    missing_as_zero: bool = False,
    stats: DataFrame | None = None,
) -> DataFrame:
    """``(x - mean) / sd`` per column; missing stays missing, constants become missing.

    ``missing_as_zero`` is the clustering variant: missing inputs count as 0
    *before* the statistics are taken, and constants contribute 0 after.
    ``stats`` is the stored row of an earlier table, whose scale is to be kept.
    """
    if missing_as_zero:
        df = df.selectExpr(*map(quoted, keys), *[f"coalesce(double({quoted(c)}), 0D) AS {quoted(c)}" for c in columns])
    with_stats = df.withColumn(STATS, _statistics(df, columns) if stats is None else stats.select("s").scalar())
    out = []
    for i, c in enumerate(columns):
        z = f"try_divide(double({quoted(c)}) - {STATS}.mean[{i}], {STATS}.scale[{i}])"
        out.append(f"coalesce({z}, 0D) AS {quoted(c)}" if missing_as_zero else f"{z} AS {quoted(c)}")
    return with_stats.selectExpr(*map(quoted, keys), *out)


def as_vectors(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``(key, vec)`` with the feature columns packed into one array."""
    packed = ", ".join(f"double({quoted(c)})" for c in columns)
    return df.selectExpr(f"{quoted(key)} AS key", f"array({packed}) AS vec")
