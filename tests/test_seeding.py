"""Oversampled starts and bounded iterations against the plain ones."""

import numpy as np
import pytest

from catalogue.queries import FEATURES, view
from peerlens.operators import clustering, seeding
from peerlens.plans.names import similarity_features
from peerlens.sources.staging import stage


def blobs(spark, n, k, seed, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(k, 6)) * 20
    rows = [(i, [float(v) for v in centres[i % k] + rng.normal(size=6)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(copies)]
    return stage(spark.createDataFrame(rows, "key long, vec array<double>"), "points")


@pytest.mark.parametrize("n, k, copies", [(400, 5, 0), (400, 5, 200), (90, 1, 0), (60, 12, 3)])
def test_bounds_change_nothing(spark, n, k, copies):
    points = blobs(spark, n, max(k, 4), 3, copies)
    starts = clustering.hash_starts(clustering.distinct_points(points), [(k, 1)])[0]
    plain = clustering.fit_all(points, [(k, 1)])[0]
    found = seeding.bounded_fit(points, starts)
    assert np.allclose(found.fit.centres, plain.centres, atol=1e-9)
    assert found.fit.cost == pytest.approx(plain.cost)


def test_far_clusters_are_looked_at_once(spark):
    points = blobs(spark, 3_000, 10, 5)
    starts = clustering.hash_starts(clustering.distinct_points(points), [(10, 4)])[0]
    found = seeding.bounded_fit(points, starts, max_iter=20)
    assert found.iterations > 2
    assert found.compared < 0.7 * found.iterations * found.points


def test_ties_and_empty_clusters(spark):
    rows = [(i, [float(v)]) for i, v in enumerate([0, 2, 4, 10, 10, 12])]
    points = stage(spark.createDataFrame(rows, "key long, vec array<double>"), "points")
    fit = seeding.bounded_fit(points, np.array([[0.0], [4.0], [99.0]])).fit
    # 2 is as near to 0 as to 4 and goes to the lower one; nobody is near 99 at first.
    plain = np.array([[0.0], [4.0], [99.0]])
    for _ in range(20):
        near = np.abs(np.array([[r[1][0] for r in rows]]).T - plain.T).argmin(axis=1)
        plain = np.array([[np.mean([r[1][0] for r, c in zip(rows, near) if c == j])] if (near == j).any() else plain[j] for j in range(3)])
    assert np.allclose(fit.centres, plain)


def test_candidates_are_few_and_weigh_all_points(spark):
    points = stage(clustering.distinct_points(blobs(spark, 2_000, 8, 1, 300)), "points")
    found, weights = seeding.oversampled(points, 8)
    assert 8 <= len(found) <= 1.5 * seeding.ROUNDS * seeding.LEAST_DRAWN
    assert weights.sum() == 2_300
    again, _ = seeding.oversampled(points.repartition(5), 8)
    assert np.array_equal(again, found)


def test_too_few_points(spark):
    points = stage(spark.createDataFrame([(1, [0.0]), (2, [0.0])], "key long, vec array<double>"), "points")
    with pytest.raises(ValueError, match="2 clusters"):
        seeding.seeded_fit(points, 2)
    with pytest.raises(ValueError, match="no points"):
        seeding.seeded_fit(points.limit(0), 2)


def test_no_worse_than_twenty_starts(spark):
    sf = "/root/testdata/sf0.01"
    points = stage(clustering.cluster_input(view(spark, sf, "v_feat"), "org_code", FEATURES), "points")
    best = clustering.best_of(clustering.fit_all(points, [(5, s) for s in range(1, 21)]))
    assert seeding.seeded_fit(points, 5, max_iter=40).fit.cost <= best.cost * (1 + 1e-9)


def test_no_worse_than_twenty_starts_on_the_index(spark):
    from catalogue.queries import CONDITIONS, _practice_table

    features = similarity_features(CONDITIONS)
    table = stage(_practice_table(spark, "/root/testdata/sf0.01").select("ORG_CODE", *features), "index")
    points = stage(clustering.cluster_input(table, "ORG_CODE", features), "points")
    best = clustering.best_of(clustering.fit_all(points, [(7, s) for s in range(1, 21)]))
    assert seeding.seeded_fit(points, 7, max_iter=40).fit.cost <= best.cost * (1 + 1e-9)
