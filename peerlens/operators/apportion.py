"""Population-weighted mapping of small-area values onto organisations.

For every organisation and metric: sum(weight * value) / sum(weight of the
areas whose value is known).

Areas are joined in a packed form: one row per area whose metrics sit in parts
of at most 25.  A weight row therefore meets ONE area row (a long join would multiply
the join output by the number of metrics), and is unrolled to one row per part
only inside the task, right before the map-side half of the aggregate.  The
sums of one part stay within generated code; a hundred in one row do not and
take twice as long.

The packed areas are stored and counted.  If they fit in memory they are
broadcast, and the weights, the big side, are then added up on the map side
without ever being shuffled row by row.  If not, both sides are sorted and
merged.

Skew: an organisation owning a large share of the rows is combined on the map
side.  An area owning a large share only matters to the sort-merge join, so
areas with more than 1/1024 of the weights are counted first: these few are
broadcast, their weights stay where they are, and only the others are sorted
and merged.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.functions.columns import quoted
from peerlens.functions.missing import sum_ignoring
from peerlens.operators.joins import BROADCAST_BYTES, heavy_hitter_join
from peerlens.operators.reshape import long_to_wide, wide_to_long
from peerlens.sources.staging import stage

PART_WIDTH = 25
MAX_METRICS = 5_000


def _parts(metrics: Sequence[str]) -> list[list[str]]:
    """The metrics in as few, equally wide parts as possible."""
    width = math.ceil(len(metrics) / math.ceil(len(metrics) / PART_WIDTH))
    return [list(metrics[i : i + width]) for i in range(0, len(metrics), width)]


def _packed(geo_wide: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """``(geo_code, parts)``: numbered parts of the metrics, the last one padded with NULL."""
    parts = _parts(metrics)
    packed = []
    for number, names in enumerate(parts):
        values = [f"double({quoted(m)})" for m in names] + ["double(NULL)"] * (len(parts[0]) - len(names))
        fields = ", ".join(f"'v{i}', {v}" for i, v in enumerate(values))
        packed.append(f"named_struct('part', {number}, {fields})")
    return geo_wide.selectExpr("geo_code", f"array({', '.join(packed)}) AS parts")


def apportion_sums(
    geo_wide: DataFrame,
    weights: DataFrame,
    metrics: Sequence[str],
    by: Sequence[str] = ("org_code",),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(by..., part, n0.., d0..)``: numerators and denominators, part by part.

    Missing products and weights count 0, so the sums add up: a coarser level
    can be rolled up from them without joining weights to areas again.
    """
    width = len(_parts(metrics)[0])
    areas = stage(_packed(geo_wide, metrics), "areas")
    row_bytes = 64 + len(_parts(metrics)) * (24 + 8 * width)
    if areas.count() * row_bytes <= broadcast_bytes:
        joined = weights.join(F.broadcast(areas), "geo_code", "inner")
    else:
        needed = weights.select("geo_code", "weighting", *by)
        joined = heavy_hitter_join(needed, areas, "geo_code")
    unrolled = joined.selectExpr(*map(quoted, by), "coalesce(double(weighting), 0D) AS w", "inline(parts)")
    return unrolled.groupBy(*by, "part").agg(
        *[F.expr(f"sum(coalesce(w * v{i}, 0D))").alias(f"n{i}") for i in range(width)],
        *[F.expr(f"sum(if(v{i} IS NULL, 0D, w))").alias(f"d{i}") for i in range(width)],
    )


def roll_up_sums(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the sums up to a coarser level."""
    columns = [c for c in sums.columns if c[0] in "nd" and c[1:].isdigit()]
    return sums.groupBy(*by, "part").agg(*[F.sum(c).alias(c) for c in columns])


def sums_to_means(sums: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Weighted means, one row per organisation, one column per metric.

    ``sums`` holds each part of an organisation once.
    """
    parts = _parts(metrics)
    width = len(parts[0])
    means = [F.expr(f"max(try_divide(n{i}, d{i}))").alias(f"m{i}") for i in range(width)]
    wide = sums.groupBy(*by).pivot("part", list(range(len(parts)))).agg(*means)
    padding = [f"__pad{i}" for i in range(len(parts) * width - len(metrics))]
    return wide.toDF(*by, *metrics, *padding).drop(*padding)


def apportion_wide(geo_wide: DataFrame, weights: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Weighted means, one row per organisation, one column per metric."""
    return sums_to_means(apportion_sums(geo_wide, weights, metrics), ["org_code"], metrics)


def apportion(geo: DataFrame, weights: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """Long contract: ``(geo_code, metric, value)`` to ``(org_code, metric, value)``.

    The areas are packed first, one row each, and every metric is reported for
    every organisation that meets an area.  Without the metric names a job looks
    them up: they become columns, so there may be ``MAX_METRICS`` at most.
    """
    if metrics is None:
        listed = geo.select("metric").where("metric IS NOT NULL").distinct().limit(MAX_METRICS + 1).collect()
        if len(listed) > MAX_METRICS:
            raise ValueError(f"more than {MAX_METRICS} metrics")
        metrics = sorted(r.metric for r in listed)
        if not metrics:
            return geo.select(F.lit("").alias("org_code"), "metric", F.col("value").cast("double")).limit(0)
    wide = long_to_wide(geo, ["geo_code"], "metric", "value", metrics)
    return wide_to_long(apportion_wide(wide, weights, metrics), ["org_code"])


def practice_weights(registrations: DataFrame) -> DataFrame:
    """Weights of each practice, straight from the registrations."""
    return registrations.select(
        F.col("prac_code").alias("org_code"), F.col("lsoa11cd").alias("geo_code"), F.col("reg_popn").alias("weighting")
    )


def parent_weights(registrations: DataFrame) -> DataFrame:
    """Weights of each practice group, summed over its practices."""
    return (
        registrations.groupBy(F.col("pcn_code").alias("org_code"), F.col("lsoa11cd").alias("geo_code"))
        .agg(sum_ignoring("reg_popn").alias("weighting"))
    )
