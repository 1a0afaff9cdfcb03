"""k-means with many seeded starts in shared passes, canonical labels and a sweep over k.

All fits (starts, and numbers of clusters) move together: one pass over the
points per iteration sums them up by fit and cluster, and only those sums, one
row per cluster, reach the driver.  Rules: starts are the k distinct points
whose hash of seed and key is smallest; a tied point goes to the lower
cluster; a cluster left without points keeps its centre.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerlens.operators.standardise import as_vectors, standardise

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package

CELLS = 1 << 21  # distances held at once in a task


@dataclass(frozen=True)
class Fit:
    """One fit: its clusters, the seed of its start, its centres and within-cluster sum of squares."""

    k: int
    seed: int
    centres: np.ndarray
    cost: float


def cluster_input(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """``(key, vec)`` for clustering: missing as 0 first, then standardised."""
    return as_vectors(standardise(df, [key], features, missing_as_zero=True), key, features)


def distinct_points(vectors: DataFrame) -> DataFrame:
    """``(vec, copies, key)``: starts are drawn among distinct points, and copies cost one row."""
    return vectors.groupBy("vec").agg(F.count(F.lit(1)).cast("double").alias("copies"), F.min("key").alias("key"))


def hash_starts(points: DataFrame, runs: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """The starting centres of each ``(k, seed)``.

    The smallest hashes are found before vectors are fetched, and each task
    passes on at most k rows a run.
    """
    wanted = F.array(*[F.struct(F.lit(i).alias("run"), F.lit(k).alias("k"), F.lit(s).alias("seed")) for i, (k, s) in enumerate(runs)])
    draws = points.select("key", F.explode(wanted).alias("w")).select(
        "key", "w.run", "w.k", F.md5(F.concat_ws(":", F.col("w.seed"), F.col("key").cast("string")).cast("binary")).alias("h")
    )
    place = F.row_number().over(Window.partitionBy("run").orderBy("h", "key"))
    most = max(k for k, _ in runs)
    first = draws.withColumn("place", place).where(F.col("place") <= most).where(F.col("place") <= F.col("k"))
    rows = first.join(points.select("key", "vec"), "key").select("run", "place", "vec").collect()
    found: list[list] = [[] for _ in runs]
    for row in sorted(rows, key=lambda r: (r.run, r.place)):
        found[row.run].append(row.vec)
    for (k, _), centres in zip(runs, found):
        if len(centres) < k:
            raise ValueError(f"{k} clusters asked of {len(centres)} distinct points")
    return [np.array(c, dtype=float) for c in found]


def chunks(vec: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of an array column as matrices of bounded size, with their first row."""
    step = max(1, CELLS // max(1, width))
    for low in range(0, len(vec), step):
        part = vec.slice(low, step)
        flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        yield low, flat.reshape(len(part), -1)


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to all centres, by one product."""
    d = (x**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * (x @ centres.T)
    return np.maximum(d, 0.0)


def _nearest(x: np.ndarray, fits: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of each fit, the lower on a tie, and the squared distance."""
    d = squared_distances(x, np.concatenate(fits))
    at = np.cumsum([0, *[len(c) for c in fits]])
    near = np.stack([d[:, a:b].argmin(axis=1) for a, b in zip(at[:-1], at[1:])], axis=1)
    return near, np.take_along_axis(d, near + at[:-1], axis=1)


def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Group function: one cluster's sums of all tasks, added one batch at a time."""
    cluster, total = None, 0.0
    for batch in batches:
        if not batch.num_rows:
            continue
        cluster = batch.column("cluster")[:1]
        flat = batch.column("sums").flatten().to_numpy()
        total = total + flat.reshape(batch.num_rows, -1).sum(axis=0)
    if cluster is not None:
        sums = pa.ListArray.from_arrays(pa.array([0, len(total)], pa.int32()), pa.array(total))
        yield pa.RecordBatch.from_arrays([cluster, sums], names=["cluster", "sums"])


def _sums(points: DataFrame, fits: Sequence[np.ndarray]) -> dict[int, tuple]:
    """For each cluster of each fit (numbered through): weight, cost and summed vector.

    A task passes on one packed row a cluster, so the plan is the same and as
    small for any number of features.
    """
    width, dims = sum(map(len, fits)), fits[0].shape[1]
    offsets = np.cumsum([0, *[len(c) for c in fits]])[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, 2 + dims))  # weight, cost, summed vector
        for batch in batches:
            copies = batch.column("copies").to_numpy()
            for low, x in chunks(batch.column("vec"), width):
                own = copies[low : low + len(x)]
                near, squared = _nearest(x, fits)
                for f, offset in enumerate(offsets):
                    to = near[:, f] + offset
                    total[:, 0] += np.bincount(to, own, minlength=width)
                    total[:, 1] += np.bincount(to, own * squared[:, f], minlength=width)
                    member = np.zeros((len(x), len(fits[f])))
                    member[np.arange(len(x)), near[:, f]] = own
                    total[offset : offset + len(fits[f]), 2:] += member.T @ x
        used = np.flatnonzero(total[:, 0])
        bounds = pa.array(np.arange(0, len(used) * (2 + dims) + 1, 2 + dims), pa.int32())
        sums = pa.ListArray.from_arrays(bounds, pa.array(total[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), sums], names=["cluster", "sums"])

    schema = "cluster long, sums array<double>"
    partial = points.select("vec", "copies").mapInArrow(run, schema)
    summed = partial.groupBy("cluster").applyInArrow(added_up, schema)
    return {r.cluster: (r.sums[0], r.sums[1], np.array(r.sums[2:])) for r in summed.collect()}


def fit_all(vectors: DataFrame, runs: Sequence[tuple[int, int]], max_iter: int = 20) -> list[Fit]:
    """Lloyd's iterations of all runs ``(k, seed)`` side by side: ``max_iter`` passes at most, and one for the costs.

    A run that has settled costs no further work.
    """
    points = distinct_points(vectors).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres = hash_starts(points, runs)
        moving = list(range(len(runs)))
        for _ in range(max_iter):
            sums = _sums(points, [centres[i] for i in moving])
            offset, still = 0, []
            for i in moving:
                moved = centres[i].copy()
                for c in range(len(moved)):
                    if offset + c in sums:
                        weight, _, total = sums[offset + c]
                        moved[c] = total / weight
                offset += len(moved)
                if not np.array_equal(moved, centres[i]):
                    still.append(i)
                centres[i] = moved
            moving = still
            if not moving:
                break
        sums, costs, offset = _sums(points, centres), [], 0
        for c in centres:
            costs.append(float(sum(sums[x][1] for x in range(offset, offset + len(c)) if x in sums)))
            offset += len(c)
    finally:
        points.unpersist()
    return [Fit(k, seed, c, cost) for (k, seed), c, cost in zip(runs, centres, costs)]


def canonical_labels(labelled: DataFrame, label: str) -> DataFrame:
    """Number clusters from 1 by size (largest first), then by smallest key.

    The ranking table has one row per cluster, so broadcasting it is bounded
    by k whatever the number of points.
    """
    sizes = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first"))
    order = Window.orderBy(F.col("n").desc(), F.col("first").asc())
    numbers = sizes.select(label, F.row_number().over(order).cast("int").alias("cluster"))
    return labelled.join(F.broadcast(numbers), label).drop(label)


def best_of(fits: Sequence[Fit]) -> Fit:
    """The fit with the lowest cost (to nine decimals), of equal ones the lowest seed."""
    return min(fits, key=lambda f: (round(f.cost, 9), f.seed))


def labelled_by(vectors: DataFrame, fit: Fit) -> DataFrame:
    """``(key, cluster)`` of one fit, canonically numbered."""
    return canonical_labels(assign_to_centroids(vectors, fit.centres), "nearest").select("key", "cluster")


def kmeans_best_of(vectors: DataFrame, k: int, starts: int = 20, max_iter: int = 20, seed: int = 1) -> DataFrame:
    """``(key, cluster)`` of the start with the lowest within-cluster sum of squares."""
    return labelled_by(vectors, best_of(fit_all(vectors, [(k, seed + i) for i in range(starts)], max_iter)))


def assign_to_centroids(vectors: DataFrame, centroids: Sequence[Sequence[float]]) -> DataFrame:
    """Number (from 0) of the nearest centroid, lowest number on a tie; no shuffle."""
    fits = [np.array(centroids, dtype=float)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, x in chunks(batch.column("vec"), len(fits[0])):
                near, squared = _nearest(x, fits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(low, len(x)), pa.array(near[:, 0].astype(np.int32)), pa.array(squared[:, 0])],
                    names=["key", "nearest", "squared_distance"],
                )

    kind = vectors.schema["key"].dataType.simpleString()
    return vectors.select("key", "vec").mapInArrow(run, f"key {kind}, nearest int, squared_distance double")


def lowest_key_centroids(vectors: DataFrame, k: int) -> list[list[float]]:
    """The k rows with the lowest keys: k vectors reach the driver, no more."""
    return [list(row.vec) for row in vectors.orderBy("key").limit(k).collect()]


def total_sum_of_squares(vectors: DataFrame) -> DataFrame:
    """Sum of squared deviations from the overall mean: the k = 1 cost.

    The vectors are centred already, so their squares are the deviations.
    """
    squares = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x)
    return vectors.agg(F.coalesce(F.sum(squares), F.lit(0.0)).alias("wss"))


def sweep_runs(k_max: int = 10, seed: int = 1) -> list[tuple[int, int]]:
    """One start for each k from 2 on."""
    return [(k, seed) for k in range(2, k_max + 1)]


def wss_of_fits(vectors: DataFrame, fits: Sequence[Fit]) -> DataFrame:
    """``(k, wss)``: the costs of the fits, and k = 1 in closed form."""
    first = total_sum_of_squares(vectors).select(F.lit(1).alias("k"), "wss")
    rows = [(f.k, f.cost) for f in fits]
    return first.unionByName(vectors.sparkSession.createDataFrame(rows, "k int, wss double"))


def wss_sweep(vectors: DataFrame, k_max: int = 10, max_iter: int = 20, seed: int = 1) -> DataFrame:
    """``(k, wss)`` for k = 1..k_max."""
    return wss_of_fits(vectors, fit_all(vectors, sweep_runs(k_max, seed), max_iter))


def labels_of_fits(vectors: DataFrame, fits: Sequence[Fit]) -> DataFrame:
    """``(key, vec, labels)``: the cluster of each point in every fit, side by side."""
    centres = [f.centres for f in fits]
    width = sum(map(len, centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, x in chunks(batch.column("vec"), width):
                near = _nearest(x, centres)[0].astype(np.int32)
                bounds = pa.array(np.arange(0, near.size + 1, near.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(low, len(x)),
                        batch.column("vec").slice(low, len(x)),
                        pa.ListArray.from_arrays(bounds, pa.array(near.ravel())),
                    ],
                    names=["key", "vec", "labels"],
                )

    kind = vectors.schema["key"].dataType.simpleString()
    return vectors.select("key", "vec").mapInArrow(run, f"key {kind}, vec array<double>, labels array<int>")
