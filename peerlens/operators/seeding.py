"""k-means for many points or clusters: few good starts, and iterations that skip what cannot change.

Seeding oversamples in rounds (k-means||): a point joins the candidates with a
probability in proportion to its squared distance from those found so far.
After a few passes the candidates, ten a cluster or some hundreds, are weighted by the
points nearest to them and reduced to k centres on the driver.

The iteration keeps, for every point, an upper bound on the distance to its own
centre and a lower one to all others (Hamerly's bounds).  When centres move,
bounds follow from how far they moved; only points whose bounds meet are
compared with the centres again, and only points that change their cluster
are added to what reaches the driver.  Points and bounds are a stored table an
iteration, so a lost executor repeats one pass at most.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.operators.clustering import Fit, added_up, chunks, distinct_points, squared_distances
from peerlens.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package

ROUNDS = 5
OVERSAMPLING = 2  # candidates a cluster and round, on average
LEAST_DRAWN = 256  # a round draws as many on average, however few the clusters
REDUCTIONS = 100  # starts tried on the candidates


def _distances(points: DataFrame, candidates: np.ndarray) -> DataFrame:
    """``(key, vec, copies, near, squared)``: number and squared distance of the nearest candidate."""
    kind = points.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, x in chunks(batch.column("vec"), len(candidates)):
                d = squared_distances(x, candidates)
                near = d.argmin(axis=1)
                part = [batch.column(c).slice(low, len(x)) for c in ("key", "vec", "copies")]
                values = pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(x)), near])
                yield pa.RecordBatch.from_arrays([*part, *values], names=["key", "vec", "copies", "near", "squared"])

    schema = f"key {kind}, vec array<double>, copies double, near int, squared double"
    return points.select("key", "vec", "copies").mapInArrow(run, schema)


def oversampled(points: DataFrame, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Candidate centres of ``distinct_points`` and the weight of the points nearest to each.

    The draws are hashes of seed, round and key, so a repeated task draws the
    same.  On average no more than ``ROUNDS`` times the larger of
    ``OVERSAMPLING * k`` and ``LEAST_DRAWN`` vectors reach the driver.
    """
    first = points.orderBy(F.xxhash64("key", F.lit(seed)), "key").select("vec").first()
    if first is None:
        raise ValueError("no points")
    found = np.array([first.vec], float)
    for number in range(ROUNDS):
        near = stage(_distances(points, found), "distances")
        cost = near.agg(F.sum(F.col("copies") * F.col("squared"))).first()[0]
        if not cost:
            break
        chance = F.col("copies") * F.col("squared") * (max(OVERSAMPLING * k, LEAST_DRAWN) / cost)
        draw = F.pmod(F.xxhash64("key", F.lit(seed), F.lit(number)), F.lit(1 << 40)) / float(1 << 40)
        drawn = near.where(draw < chance).orderBy("key").select("vec").collect()
        if drawn:
            found = np.concatenate([found, np.array([r.vec for r in drawn], float)])
    sums = _distances(points, found).groupBy("near").agg(F.sum("copies").alias("weight")).collect()
    weights = np.zeros(len(found))
    for r in sums:
        weights[r.near] = r.weight
    return found, weights


def _iterated(x: np.ndarray, w: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Lloyd's iteration of some weighted rows; the cluster of each."""
    for _ in range(50):
        near = squared_distances(x, centres).argmin(axis=1)
        weight = np.bincount(near, w, minlength=len(centres))
        member = np.zeros((len(x), len(centres)))
        member[np.arange(len(x)), near] = w
        moved = np.where(weight[:, None] > 0, (member.T @ x) / np.maximum(weight, 1e-300)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return near


def _single_moves(x: np.ndarray, w: np.ndarray, near: np.ndarray, k: int, sweeps: int = 20) -> tuple[np.ndarray, float]:
    """Rows moved one by one as long as that lowers the cost, which can go on where all rows are nearest to their own centre."""
    near = near.copy()
    weight = np.bincount(near, w, minlength=k)
    total = np.zeros((k, x.shape[1]))
    np.add.at(total, near, w[:, None] * x)
    for _ in range(sweeps):
        moved = False
        for i in range(len(x)):
            own = near[i]
            if weight[own] - w[i] <= 1e-9:
                continue
            d = ((total / np.maximum(weight, 1e-300)[:, None] - x[i]) ** 2).sum(axis=1)
            change = w[i] * weight / (weight + w[i]) * d
            change[own] = w[i] * weight[own] / (weight[own] - w[i]) * d[own]
            to = int(change.argmin())
            if to != own and change[to] < change[own] * (1 - 1e-12):
                near[i], moved = to, True
                for c, sign in ((own, -1.0), (to, 1.0)):
                    weight[c] += sign * w[i]
                    total[c] += sign * w[i] * x[i]
        if not moved:
            break
    centres = total / np.maximum(weight, 1e-300)[:, None]
    return centres, float((((x - centres[near]) ** 2).sum(axis=1) * w).sum())


def reduced(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """k centres of the weighted candidates: the best of some starts, iterated and then refined by single moves.

    Every other start is drawn by distance, the others by weight alone: where
    there are many dimensions and few points, distance favours stray points.
    """
    some = weights > 0
    x, w = candidates[some], weights[some]
    if len(np.unique(x, axis=0)) < k:
        raise ValueError(f"{k} clusters asked of {len(np.unique(x, axis=0))} candidates")
    best, least = None, np.inf
    for attempt in range(REDUCTIONS):
        rng = np.random.default_rng([seed, attempt])
        centres = x[rng.choice(len(x), 1, p=w / w.sum())]
        while len(centres) < k:
            d = squared_distances(x, centres).min(axis=1)
            d = np.where(d > 1e-12, w * (d if attempt % 2 else 1.0), 0.0)
            if not d.sum() > 0:
                break
            centres = np.concatenate([centres, x[rng.choice(len(x), 1, p=d / d.sum())]])
        if len(centres) == k:
            centres, cost = _single_moves(x, w, _iterated(x, w, centres), k)
            if cost < least:
                best, least = centres, cost
    if best is None:
        raise ValueError(f"{k} clusters asked of points that lie too close together")
    return best


@dataclass
class BoundedFit:
    """A fit, the number of its iterations, and how many points were compared with the centres in all of them."""

    fit: Fit
    iterations: int
    compared: int
    points: int


def _begin(centres: np.ndarray):
    """First pass: own cluster, both bounds, and the sums of each cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, x in chunks(batch.column("vec"), len(centres)):
                d = np.sqrt(squared_distances(x, centres))
                own, upper, lower = _two_nearest(d)
                part = [batch.column(c).slice(low, len(x)) for c in ("key", "vec", "copies")]
                names = ["key", "vec", "copies", "own", "before", "upper", "lower", "looked"]
                before = np.full(len(x), -1, np.int32)
                values = [own.astype(np.int32), before, upper, lower, np.ones(len(x), bool)]
                yield pa.RecordBatch.from_arrays([*part, *map(pa.array, values)], names=names)

    return run


def _two_nearest(d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centre, the lower on a tie, its distance, and the distance of the next one."""
    own = d.argmin(axis=1)
    rows = np.arange(len(d))
    upper = d[rows, own]
    if d.shape[1] == 1:
        return own, upper, np.full(len(d), np.inf)
    rest = d.copy()
    rest[rows, own] = np.inf
    return own, upper, rest.min(axis=1)


def _follow(centres: np.ndarray, moved: np.ndarray):
    """A pass after the centres moved by ``moved``: bounds follow, points whose bounds meet are compared again."""
    apart = np.sqrt(squared_distances(centres, centres))
    np.fill_diagonal(apart, np.inf)
    half = apart.min(axis=1) / 2 if len(centres) > 1 else np.full(1, np.inf)
    # How far any centre but one's own may have come nearer.
    order = np.argsort(moved)
    most, second = order[-1], order[-2] if len(order) > 1 else order[-1]
    nearer = np.where(np.arange(len(moved)) == most, moved[second] if len(order) > 1 else 0.0, moved[most])
    # Products lose digits, the more the longer the vectors; bounds that are nearly equal do not count.
    reach = 1.0 + np.sqrt((centres**2).sum(axis=1).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, x in chunks(batch.column("vec"), len(centres)):
                col = lambda c: batch.column(c).slice(low, len(x)).to_numpy(zero_copy_only=False)
                own = before = col("own").astype(np.int64)
                upper, lower = col("upper") + moved[own], col("lower") - nearer[own]
                look = upper + 1e-7 * (reach + upper) >= np.maximum(lower, half[own])
                if look.any():
                    own = own.copy()
                    own[look], upper[look], lower[look] = _two_nearest(np.sqrt(squared_distances(x[look], centres)))
                part = [batch.column(c).slice(low, len(x)) for c in ("key", "vec", "copies")]
                names = ["key", "vec", "copies", "own", "before", "upper", "lower", "looked"]
                values = [own.astype(np.int32), before.astype(np.int32), upper, lower, look]
                yield pa.RecordBatch.from_arrays([*part, *map(pa.array, values)], names=names)

    return run


def _moves(k: int, dims: int):
    """Packed per task: what each cluster gained and lost in weight and sum, and how many points were looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, 1 + dims))
        for batch in batches:
            for low, x in chunks(batch.column("vec"), k):
                col = lambda c: batch.column(c).slice(low, len(x)).to_numpy(zero_copy_only=False)
                own, before, copies = col("own"), col("before"), col("copies")
                total[k, 0] += col("looked").sum()
                other = np.flatnonzero(own != before)
                values = np.hstack([np.ones((len(other), 1)), x[other]]) * copies[other, None]
                np.add.at(total, own[other], values)
                was = before[other] >= 0
                np.subtract.at(total, before[other][was], values[was])
        used = np.flatnonzero(total.any(axis=1))
        bounds = pa.array(np.arange(0, len(used) * (1 + dims) + 1, 1 + dims), pa.int32())
        sums = pa.ListArray.from_arrays(bounds, pa.array(total[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), sums], names=["cluster", "sums"])

    return run


def bounded_fit(vectors: DataFrame, centres: np.ndarray, max_iter: int = 20, seed: int = 0) -> BoundedFit:
    """Lloyd's iteration of ``(key, vec)`` from given centres, by bounds.

    Ties and empty clusters as elsewhere: the lower cluster, and its centre stays.
    """
    points = stage(distinct_points(vectors), "points")
    kind = points.schema["key"].dataType.simpleString()
    schema = f"key {kind}, vec array<double>, copies double, own int, before int, upper double, lower double, looked boolean"
    centres = np.array(centres, float)
    k, dims = centres.shape
    weight, total = np.zeros(k), np.zeros((k, dims))
    state, moved, compared, iterations = None, np.zeros(k), 0, 0
    for _ in range(max_iter):
        source = points if state is None else state
        step = _begin(centres) if state is None else _follow(centres, moved)
        state = stage(source.mapInArrow(step, schema), "bounds")
        sums = state.mapInArrow(_moves(k, dims), "cluster long, sums array<double>")
        for row in sums.groupBy("cluster").applyInArrow(added_up, "cluster long, sums array<double>").collect():
            if row.cluster == k:
                compared += int(row.sums[0])
            else:
                weight[row.cluster] += row.sums[0]
                total[row.cluster] += row.sums[1:]
        iterations += 1
        now = np.where(weight[:, None] > 0.5, total / np.maximum(weight, 1.0)[:, None], centres)
        moved = np.sqrt(((now - centres) ** 2).sum(axis=1))
        centres = now
        if moved.max() <= 1e-12:
            break
    cost = _distances(points, centres).agg(F.sum(F.col("copies") * F.col("squared"))).first()[0] or 0.0
    return BoundedFit(Fit(k, seed, centres, float(cost)), iterations, compared, points.count())


def seeded_fit(vectors: DataFrame, k: int, max_iter: int = 20, seed: int = 1) -> BoundedFit:
    """A fit from oversampled starts."""
    candidates, weights = oversampled(stage(distinct_points(vectors), "points"), k, seed)
    return bounded_fit(vectors, reduced(candidates, weights, k, seed), max_iter, seed)
