"""Grouped sums, ratios of sums and frequency-weighted quantiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.functions.missing import ratio, sum_ignoring, sum_poisoning
from peerlens.functions.text import count_and_rate


def grouped_sums(df: DataFrame, by: Sequence[str], columns: Sequence[str], missing: str = "ignore") -> DataFrame:
    """Sum columns per group; ``missing`` is ``ignore`` or ``poison``."""
    rule = {"ignore": sum_ignoring, "poison": sum_poisoning}[missing]
    return df.groupBy(*by).agg(*[rule(c).alias(c) for c in columns])


def ratio_rollup(df: DataFrame, by: Sequence[str], numerator: str, denominator: str, out: str) -> DataFrame:
    """Ratio of the grouped sums (never a mean of ratios)."""
    sums = grouped_sums(df, by, [numerator, denominator])
    return sums.select(*by, ratio(numerator, denominator).alias(out))


def weighted_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    frequencies: Sequence[str],
    quantiles: Mapping[str, float],
    total: str = "popn",
    spread: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Exact interpolated quantiles of ``value`` under several frequency columns.

    One aggregate answers every frequency column; its state is the count per
    distinct value, so a group's memory follows the number of distinct values,
    not its rows.  Columns come out as ``<quantile>_<frequency>``; ``spread`` is
    ``(name, high, low)`` for a difference of two quantiles.
    """
    probabilities = F.array(*[F.lit(float(p)) for p in quantiles.values()])
    aggregates = []
    for f in frequencies:
        aggregates.append(F.percentile(F.col(value), probabilities, F.col(f)).alias(f"__q_{f}"))
        aggregates.append(sum_poisoning(f).alias(f"__t_{f}"))
    grouped = df.groupBy(*by).agg(*aggregates)
    blocks: dict[str, list] = {name: [] for name in quantiles}
    order = list(quantiles)
    for i, name in enumerate(order):
        blocks[name] = [F.col(f"__q_{f}")[i].alias(f"{name}_{f}") for f in frequencies]
    if spread:
        label, high, low = spread
        blocks[label] = [
            (F.col(f"__q_{f}")[order.index(high)] - F.col(f"__q_{f}")[order.index(low)]).alias(f"{label}_{f}")
            for f in frequencies
        ]
    blocks[total] = [F.col(f"__t_{f}").alias(f"{total}_{f}") for f in frequencies]
    return grouped.select(*by, *[c for columns in blocks.values() for c in columns])


def removal_report(df: DataFrame, kept) -> DataFrame:
    """Rows, rows a filter removes, and their printed rate, in one pass."""
    removed = F.count(F.lit(1)) - F.count_if(kept)
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"), removed.alias("n_removed"))
        .withColumn("report", count_and_rate(F.col("n_removed"), F.col("n_rows")))
    )
