"""Euclidean silhouettes, exact, without storing the pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlens.operators.blocks import cluster_distance_sums, label_distance_sums, to_block_pairs
from peerlens.operators.clustering import Fit, fit_all, labels_of_fits, sweep_runs, wss_of_fits
from peerlens.operators.neighbours import staged_vectors
from peerlens.sources.staging import stage


def _width(sums: Column, own: Column, counts: Sequence[int]) -> Column:
    """Silhouette of one point from its distance sums, its cluster and the cluster sizes."""
    sizes = F.array(*[F.lit(float(c)) for c in counts])
    positions = F.sequence(F.lit(0), F.lit(len(counts) - 1))
    own_size = F.get(sizes, own)
    inner = F.try_divide(F.get(sums, own), own_size - 1)
    others = F.transform(
        positions, lambda i: F.when((i != own) & (F.get(sizes, i) > 0), F.get(sums, i) / F.get(sizes, i))
    )
    outer = F.array_min(others)
    width = F.coalesce(F.try_divide(outer - inner, F.greatest(inner, outer)), F.lit(0.0))
    return F.when(own_size > 1, width).otherwise(F.lit(0.0))


def silhouette_widths(labelled: DataFrame, groups: Sequence[int]) -> DataFrame:
    """``(key, widths)``: one silhouette per labelling for each point.

    ``labelled`` is ``(key, vec, labels)`` with cluster numbers from 0 and
    ``groups`` the number of clusters per labelling.  All labellings share one
    pass over the block pairs.  Only the cluster sizes reach the driver.
    """
    stored, plan = staged_vectors(labelled)
    flat_sizes = stored.agg(
        *[
            F.count_if(F.get("labels", F.lit(j)) == c).alias(f"n_{j}_{c}")
            for j, g in enumerate(groups)
            for c in range(g)
        ]
    ).first()
    kind = labelled.schema["key"].dataType.simpleString()
    partial = (
        to_block_pairs(stored, plan)
        .groupBy("pair")
        .applyInArrow(cluster_distance_sums(list(groups)), f"key {kind}, sums array<double>")
    )
    width = sum(groups)
    sums = partial.groupBy("key").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))
    joined = sums.join(stored.select("key", "labels"), "key")
    columns, offset = [], 0
    for j, g in enumerate(groups):
        part = F.slice("sums", offset + 1, g)
        counts = [flat_sizes[f"n_{j}_{c}"] for c in range(g)]
        columns.append(_width(part, F.get("labels", F.lit(j)), counts))
        offset += g
    return joined.select("key", "labels", F.array(*columns).alias("widths"))


def silhouette_of_labels(points: DataFrame, label: str) -> DataFrame:
    """``(key, <label>, width)`` for given labels of any type and number; a null is a label like any other.

    Labels are numbered by a join, and sums and sizes stay rows: the number of
    labels bounds neither a plan nor a task.
    """
    labels = points.select(label).distinct()
    numbers = stage(
        labels.select(F.col(label).alias("name"), F.monotonically_increasing_id().alias("number")),
        "labels",
    )
    numbered = points.join(numbers, F.col(label).eqNullSafe(F.col("name"))).select("key", "vec", "number")
    stored, plan = staged_vectors(numbered)
    kind = stored.schema["key"].dataType.simpleString()
    partial = (
        to_block_pairs(stored, plan)
        .groupBy("pair")
        .applyInArrow(label_distance_sums(), f"key {kind}, number long, sum double")
    )
    sums = partial.groupBy("key", "number").agg(F.sum("sum").alias("sum"))
    sizes = stored.groupBy("number").agg(F.count(F.lit(1)).alias("size"))
    own = stored.select("key", F.col("number").alias("own"))
    same = F.col("number") == F.col("own")
    compared = (
        sums.join(sizes, "number")
        .join(own, "key")
        .groupBy("key", "own")
        .agg(
            F.max(F.when(same & (F.col("size") > 1), F.col("sum") / (F.col("size") - 1))).alias("inner"),
            F.min(F.when(~same, F.col("sum") / F.col("size"))).alias("outer"),
        )
    )
    width = F.coalesce(
        F.try_divide(F.col("outer") - F.col("inner"), F.greatest("inner", "outer")), F.lit(0.0)
    )
    return compared.join(numbers, F.col("own") == F.col("number")).select(
        "key", F.col("name").alias(label), F.when(F.col("inner").isNotNull(), width).otherwise(F.lit(0.0)).alias("width")
    )


def silhouettes_of_fits(vectors: DataFrame, fits: Sequence[Fit]) -> DataFrame:
    """``(k, mean_silhouette)`` for k = 1 (0 by definition) and every fit, from one pass over the pairs."""
    ks = [f.k for f in fits]
    widths = silhouette_widths(labels_of_fits(vectors, fits), ks)
    means = [F.struct(F.lit(1).alias("k"), F.lit(0.0).alias("mean_silhouette"))]
    for j, k in enumerate(ks):
        means.append(F.struct(F.lit(k).alias("k"), F.avg(F.get("widths", F.lit(j))).alias("mean_silhouette")))
    return widths.agg(F.array(*means).alias("rows")).select(F.inline("rows"))


def silhouette_sweep(vectors: DataFrame, k_max: int = 10, max_iter: int = 20, seed: int = 1) -> DataFrame:
    """``(k, mean_silhouette)`` for k = 1..k_max."""
    return silhouettes_of_fits(vectors, fit_all(vectors, sweep_runs(k_max, seed), max_iter))


def k_diagnostics(vectors: DataFrame, fits: Sequence[Fit]) -> DataFrame:
    """``(k, wss, mean_silhouette)`` of fits made before."""
    return wss_of_fits(vectors, fits).join(silhouettes_of_fits(vectors, fits), "k")
