"""Silhouettes of large tables from weighted samples, each with an interval it lies in.

A silhouette needs each point's summed distance to every cluster.  The sum W(x)
over a cluster C is estimated by a sample in which a member y is drawn with
probability p(y) = min(1, t g(y)) and counts 1 / p(y).  A few pivots of C, drawn
evenly, give g(y) = max(1 / |C|, max over pivots z of d(y, z) / W(z)).

Why the bound holds: if one pivot z is in that half of C which is nearer to x,
then d(x, z) <= 2 W(x) / |C| and W(z) <= 3 W(x), hence d(x, y) <= 5 g(y) W(x) for
every y, and no drawn term exceeds 5 W(x) / t.  Bernstein's inequality makes the
sum right within the factor 1 +- epsilon if t = 10 (1 + epsilon / 3) / epsilon^2 ln(4 n k / delta);
h = log2(2 n k / delta) pivots fail for no point.  So with probability 1 - delta
all sums of all points hold at once, and with them all intervals.

Clusters of at most t points are taken whole and are exact.  The cost is n times
the size of the samples, linear in the rows.  Samples are a stored table that
tasks read piece by piece; only sizes, pivots (at most ``MOST_LABELS`` times some
forty) and their sums reach the driver.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerlens.sources.shared_files import files_of, opened
from peerlens.sources.staging import new_folder, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Samples of all clusters are compared with every point, so there may not be many clusters.
MOST_LABELS = 1000
POINTS, SAMPLES = 512, 1024  # of one matrix product; some six arrays of that size are held
CLOSE = 1e-6  # squared distances below this share of the squared lengths are recomputed from differences


def sample_weight(n: int, k: int, epsilon: float, delta: float) -> float:
    """The ``t`` of the module's text."""
    return 10 * (1 + epsilon / 3) / epsilon**2 * math.log(4 * n * k / delta)


def pivot_count(n: int, k: int, delta: float) -> int:
    return math.ceil(math.log2(2 * n * k / delta))


def matrix_of(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if vectors.null_count or vectors.flatten().null_count:
        raise ValueError("silhouettes need vectors without missing values")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances between two sets of points."""
    lengths = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :]
    squared = lengths - 2 * (x @ y.T)
    i, j = np.nonzero(squared <= CLOSE * lengths)
    for low in range(0, len(i), 100_000):
        a, b = i[low : low + 100_000], j[low : low + 100_000]
        squared[a, b] = ((x[a] - y[b]) ** 2).sum(1)
    return np.sqrt(squared)


def _pivot_sums(pivots: dict[int, np.ndarray]):
    """Map function: summed distances of each cluster's points to its pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {c: np.zeros(len(z)) for c, z in pivots.items()}
        for batch in batches:
            own, x = batch.column("own").to_numpy(), matrix_of(batch.column("vec"))
            for c in np.intersect1d(own, list(pivots)):
                mine = x[own == c]
                for low in range(0, len(mine), POINTS):
                    sums[c] += distances(mine[low : low + POINTS], pivots[c]).sum(0)
        rows = [(c, i, s) for c, all_sums in sums.items() for i, s in enumerate(all_sums.tolist())]
        names = ["own", "pivot", "sum"]
        yield pa.RecordBatch.from_pydict(
            {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, (pa.int64(), pa.int32(), pa.float64())))}
        )

    return run


def _chances(pivots: dict[int, np.ndarray], sums: dict[int, np.ndarray], sizes: list[int], t: float):
    """Map function: ``(own, vec, p)`` of the points that are drawn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, x, drawn = batch.column("own").to_numpy(), matrix_of(batch.column("vec")), batch.column("u").to_numpy()
            p = np.ones(len(own))
            for c in np.intersect1d(own, list(pivots)):
                mine = np.flatnonzero(own == c)
                for low in range(0, len(mine), POINTS):
                    some = mine[low : low + POINTS]
                    far = distances(x[some], pivots[c])
                    shares = np.divide(far, sums[c], out=np.zeros_like(far), where=sums[c] > 0).max(1)
                    p[some] = np.minimum(1.0, t * np.maximum(shares, 1 / sizes[c]))
            keep = pa.array(np.flatnonzero(drawn < p))
            yield pa.RecordBatch.from_arrays(
                [batch.column("own").take(keep), batch.column("vec").take(keep), pa.array(p).take(keep)], names=["own", "vec", "p"]
            )

    return run


def width_of(inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
    larger = np.maximum(inner, outer)
    return np.divide(outer - inner, larger, out=np.zeros_like(larger), where=larger > 0)


def _estimates(folder: str, sizes: list[int], loose: list[float]):
    """Map function: width and interval of each point, the samples read piece by piece."""
    n_of, slack = np.array(sizes, float), np.array(loose)

    def samples() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for path, _ in files_of(folder, ".parquet"):
            with opened(path) as file:
                for piece in pq.ParquetFile(file).iter_batches(SAMPLES, columns=["own", "vec", "p"]):
                    if len(piece):
                        own = piece.column("own").to_numpy()
                        order = np.argsort(own, kind="stable")
                        yield own[order], matrix_of(piece.column("vec"))[order], piece.column("p").to_numpy()[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, x = batch.column("own").to_numpy(), matrix_of(batch.column("vec"))
            if not len(own):
                continue
            sums = np.zeros((len(own), len(sizes)))
            for cluster, y, p in samples():
                present, starts = np.unique(cluster, return_index=True)
                for low in range(0, len(x), POINTS):
                    sums[low : low + POINTS, present] += np.add.reduceat(distances(x[low : low + POINTS], y) / p, starts, axis=1)
            at = np.arange(len(own))
            inner = sums[at, own] / np.maximum(n_of[own] - 1, 1)
            means = sums / n_of
            means[at, own] = np.inf
            alone = (n_of[own] == 1) | (len(sizes) == 1)

            def put(a: np.ndarray, b: np.ndarray) -> pa.Array:
                return pa.array(np.where(alone, 0.0, width_of(a, np.where(np.isinf(b), 0.0, b))))

            mine = slack[own]
            found = [
                put(inner, means.min(1)),
                put(inner / (1 - mine), (means / (1 + slack)).min(1)),
                put(inner / (1 + mine), (means / (1 - slack)).min(1)),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("own"), *found], names=["key", "own", "width", "low", "high"])

    return run


def sampled_silhouettes(points: DataFrame, label: str, epsilon: float = 0.2, delta: float = 0.05, seed: int = 1) -> DataFrame:
    """``(key, <label>, width, low, high)`` of ``points(key, vec, <label>)``; a null label is a label like any other.

    With probability ``1 - delta`` every exact width lies between its ``low`` and
    ``high``.  Keys are unique; vectors have no missing values.
    """
    if not 0 < epsilon < 1 or not 0 < delta < 1:
        raise ValueError("epsilon and delta lie between 0 and 1")
    spark = points.sparkSession
    sizes = points.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    known = sizes.orderBy(F.col(label).asc_nulls_first()).limit(MOST_LABELS + 1).collect()
    if len(known) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels; silhouette_of_labels has no such bound")
    kind = points.schema[label].dataType.simpleString()
    names = spark.createDataFrame([(r[0], i) for i, r in enumerate(known)], f"name {kind}, own long")
    counts = [r["size"] for r in known]
    n, k = sum(counts), max(1, len(counts))
    numbered = points.join(F.broadcast(names), F.col(label).eqNullSafe(F.col("name"))).select(
        "key", F.col("vec").cast("array<double>").alias("vec"), "own"
    )
    draw = [F.expr(f"pmod(xxhash64(key, {seed + i}), 1L << 53) / CAST(1L << 53 AS DOUBLE)").alias(c) for i, c in enumerate(("u", "pick"))]
    stored = stage(numbered.select("*", *draw), "silhouette-points")

    t = sample_weight(max(n, 1), k, epsilon, delta)
    large = [c for c, size in enumerate(counts) if size > t]
    pivots, sums = {}, {}
    if large:
        order = Window.partitionBy("own").orderBy("pick", "key")
        firsts = stored.where(F.col("own").isin(large)).withColumn("place", F.row_number().over(order))
        for r in firsts.where(F.col("place") <= pivot_count(n, k, delta)).select("own", "vec").collect():
            pivots.setdefault(r.own, []).append(r.vec)
        pivots = {c: np.array(z) for c, z in pivots.items()}
        sums = {c: np.zeros(len(z)) for c, z in pivots.items()}
        partial = stored.select("own", "vec").mapInArrow(_pivot_sums(pivots), "own long, pivot int, sum double")
        for r in partial.groupBy("own", "pivot").agg(F.sum("sum").alias("sum")).collect():
            sums[r.own][r.pivot] = r.sum
    folder = new_folder(spark, "silhouette-sample")
    drawn = stored.select("own", "vec", "u").mapInArrow(_chances(pivots, sums, counts, t), "own long, vec array<double>, p double")
    drawn.write.parquet(folder)
    loose = [epsilon if c in pivots else 0.0 for c in range(len(counts))]
    key = points.schema["key"].dataType.simpleString()
    found = stored.select("key", "own", "vec").mapInArrow(
        _estimates(folder, counts, loose), f"key {key}, own long, width double, low double, high double"
    )
    return found.join(F.broadcast(names), "own").select("key", F.col("name").alias(label), "width", "low", "high")


def mean_silhouette(estimates: DataFrame) -> DataFrame:
    """One row: the mean width and its interval."""
    return estimates.agg(*[F.avg(c).alias(c) for c in ("width", "low", "high")])
