"""k-means and silhouettes: properties and a plain recomputation."""

import math

import numpy as np
import pytest

from peerlens.operators.clustering import (
    assign_to_centroids,
    canonical_labels,
    cluster_input,
    kmeans_best_of,
    distinct_points,
    fit_all,
    total_sum_of_squares,
    wss_sweep,
)
from peerlens.operators.silhouette import silhouette_of_labels, silhouette_sweep


def blobs(n=90, p=4, centres=3, seed=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, p)) * 8
    return [(f"k{i:03d}", [float(v) for v in middle[i % centres] + rng.normal(size=p)]) for i in range(n)]


def within(rows, labels):
    total = 0.0
    for c in set(labels.values()):
        part = np.array([v for k, v in rows if labels[k] == c])
        total += float(((part - part.mean(axis=0)) ** 2).sum())
    return total


def labels_of(df):
    return {r.key: r.cluster for r in df.collect()}


def test_best_of_many_starts(spark):
    rows = blobs()
    points = spark.createDataFrame(rows, "key string, vec array<double>")
    many = labels_of(kmeans_best_of(points, k=3, starts=6, seed=3))
    again = labels_of(kmeans_best_of(points, k=3, starts=6, seed=3))
    assert many == again
    assert set(many.values()) == {1, 2, 3}
    for seed in (3, 4, 8):
        single = labels_of(kmeans_best_of(points, k=3, starts=1, seed=seed))
        assert within(rows, many) <= within(rows, single) + 1e-9
    truth = {k: i % 3 for i, (k, _) in enumerate(rows)}
    assert len({(truth[k], c) for k, c in many.items()}) == 3


def test_labels_follow_size_then_first_key(spark):
    df = spark.createDataFrame([("d", 7), ("a", 9), ("b", 9), ("c", 4), ("e", 4), ("f", 4)], "key string, raw int")
    got = {r.key: r.cluster for r in canonical_labels(df, "raw").collect()}
    assert got == {"c": 1, "e": 1, "f": 1, "a": 2, "b": 2, "d": 3}


def test_tied_centroids_take_the_lower_number(spark):
    points = spark.createDataFrame([("a", [0.0]), ("b", [2.0])], "key string, vec array<double>")
    got = {r.key: (r.nearest, r.squared_distance) for r in assign_to_centroids(points, [[1.0], [-1.0], [1.0]]).collect()}
    assert got == {"a": (0, 1.0), "b": (0, 1.0)}


def test_missing_counts_as_zero_before_scaling(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", None, 5.0), ("c", 3.0, 5.0)], "k string, x double, c double")
    got = {r.key: r.vec for r in cluster_input(df, "k", ["x", "c"]).collect()}
    x = np.array([1.0, 0.0, 3.0])
    z = (x - x.mean()) / x.std(ddof=1)
    assert [got[k][0] for k in "abc"] == pytest.approx(list(z))
    assert all(v[1] == 0.0 for v in got.values())


def test_wss_sweep(spark):
    rows = blobs()
    data = np.array([v for _, v in rows])
    data = (data - data.mean(axis=0)) / data.std(axis=0, ddof=1)
    points = spark.createDataFrame([(k, list(map(float, v))) for (k, _), v in zip(rows, data)], "key string, vec array<double>")
    sweep = {r.k: r.wss for r in wss_sweep(points, k_max=5).collect()}
    assert sorted(sweep) == [1, 2, 3, 4, 5]
    assert sweep[1] == pytest.approx(float((data**2).sum()))
    assert sweep[1] == pytest.approx(total_sum_of_squares(points).first().wss)
    assert all(sweep[k] < sweep[1] for k in (2, 3, 4, 5))


def plain_silhouettes(rows, labels):
    out = {}
    for k, x in rows:
        sums, counts = {}, {}
        for j, y in rows:
            if j != k:
                c = labels[j]
                sums[c] = sums.get(c, 0.0) + math.dist(x, y)
                counts[c] = counts.get(c, 0) + 1
        own = labels[k]
        if own not in counts:
            out[k] = 0.0
            continue
        a = sums[own] / counts[own]
        b = min(sums[c] / counts[c] for c in counts if c != own)
        out[k] = (b - a) / max(a, b) if max(a, b) > 0 else 0.0
    return out


def test_silhouettes_match_a_double_loop(spark):
    rows = blobs(70, centres=4)
    rows += [("copy1", rows[0][1]), ("copy2", rows[0][1])]
    labels = {k: ["red", "green", "blue"][i % 3] for i, (k, _) in enumerate(rows)}
    labels[rows[5][0]] = "alone"
    df = spark.createDataFrame([(k, v, labels[k]) for k, v in rows], "key string, vec array<double>, label string")
    got = {r.key: (r.label, r.width) for r in silhouette_of_labels(df, "label").collect()}
    want = plain_silhouettes(rows, labels)
    assert got.keys() == want.keys()
    assert all(got[k][0] == labels[k] and abs(got[k][1] - want[k]) < 1e-9 for k in want)


def test_silhouette_sweep_peaks_at_the_true_number(spark):
    points = spark.createDataFrame(blobs(), "key string, vec array<double>")
    sweep = {r.k: r.mean_silhouette for r in silhouette_sweep(points, k_max=5, seed=7).collect()}
    assert sorted(sweep) == [1, 2, 3, 4, 5]
    assert sweep[1] == 0.0
    assert all(-1 <= s <= 1 for s in sweep.values())


def test_copies_do_not_crowd_out_the_starts(spark):
    """Half of the points are one point; every start still gets distinct centres."""
    rows = blobs(60)
    rows += [(f"z{i}", rows[0][1]) for i in range(60)]
    points = spark.createDataFrame(rows, "key string, vec array<double>")
    labels = labels_of(kmeans_best_of(points, k=3, starts=8, seed=2))
    assert set(labels.values()) == {1, 2, 3}
    assert len({labels[k] for k, v in rows if v == rows[0][1]}) == 1
    with pytest.raises(ValueError, match="distinct points"):
        kmeans_best_of(spark.createDataFrame(rows[60:], points.schema), k=2)


def test_shared_passes_give_what_single_fits_give(spark):
    points = spark.createDataFrame(blobs(), "key string, vec array<double>")
    runs = [(3, 1), (2, 5), (4, 1)]
    together = fit_all(points, runs)
    for run, fit in zip(runs, together):
        alone = fit_all(points, [run])[0]
        assert np.allclose(fit.centres, alone.centres) and fit.cost == pytest.approx(alone.cost)


def test_costs_compete_with_another_solver(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = blobs(200, 5, 6, seed=9)
    points = spark.createDataFrame(rows, "key string, vec array<double>")
    ours = min(f.cost for f in fit_all(points, [(6, s) for s in range(1, 21)]))
    features = points.select(array_to_vector("vec").alias("features"))
    theirs = min(KMeans(k=6, seed=s, maxIter=20).fit(features).summary.trainingCost for s in range(1, 6))
    assert ours <= theirs * 1.01


def test_an_empty_cluster_keeps_its_centre_and_copies_weigh(spark):
    rows = [("a", [0.0]), ("b", [0.0]), ("c", [0.0]), ("d", [4.0])]
    points = spark.createDataFrame(rows, "key string, vec array<double>")
    assert sorted(r.copies for r in distinct_points(points).collect()) == [1.0, 3.0]
    fit = fit_all(points, [(1, 1)])[0]
    assert fit.centres.tolist() == [[1.0]] and fit.cost == pytest.approx(12.0)
    assert fit_all(points, [(2, 1)])[0].cost == 0.0


def test_silhouettes_of_very_many_labels_and_a_null_one(spark):
    n = 3000
    df = spark.range(n).selectExpr(
        "id AS key", "array(double(id), double(id % 7)) AS vec", "CASE WHEN id < 4 THEN NULL ELSE id DIV 2 END AS label"
    )
    got = {r.key: r for r in silhouette_of_labels(df, "label").collect()}
    assert len(got) == n and {got[i].label for i in range(4)} == {None}
    rows = [(r.key, r.vec) for r in df.filter("id < 60").collect()]
    labels = {r.key: r.label for r in df.filter("id < 60").collect()}
    few = silhouette_of_labels(df.filter("id < 60"), "label").collect()
    want = plain_silhouettes(rows, labels)
    assert all(abs(r.width - want[r.key]) < 1e-9 for r in few)
