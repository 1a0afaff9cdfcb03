"""Pruned neighbour lists against the full comparison and a plain double loop."""

import numpy as np
import pyarrow as pa
import pytest

from peerlens.operators import balls
from peerlens.operators.balls import ball_lists
from peerlens.operators.blocks import candidates
from peerlens.operators.neighbours import nearest_and_farthest
from peerlens.sources.staging import stage
from tests.test_distance import brute, brute_lists, rows_with_everything

BOTH = ["nearest", "farthest"]


def lists_of(df, which):
    out = {}
    order = lambda r: (r.orig, r.place)
    for r in sorted(df.where(f"list = '{which}'").collect(), key=order):
        out.setdefault(r.orig, []).append(r.dest)
    return out


def ranked(found, k):
    """Every list in its order, by the plain rule."""
    out = {which: {} for which in BOTH}
    for r in found.lists.collect():
        out[r.list].setdefault(r.orig, []).append((float("inf") if r.rank_distance is None else r.rank_distance, r.dest))
    for which, lists in out.items():
        for orig, rows in lists.items():
            rows.sort(key=lambda t: t[1], reverse=which == "farthest")
            rows.sort(key=lambda t: t[0], reverse=which == "farthest")
            lists[orig] = [dest for _, dest in rows]
    return out


def stored(spark, rows, kind="string"):
    return stage(spark.createDataFrame(rows, f"key {kind}, vec array<double>"), "test")


@pytest.mark.parametrize("ball_rows, max_rows", [(10, 32768), (10, 12), (1000, 40)])
def test_lists_with_missing_values_and_copies(spark, ball_rows, max_rows):
    rows = rows_with_everything(150, 6, 1)
    want = brute(rows)
    found = ball_lists(stored(spark, rows), 4, BOTH, ball_rows, max_rows)
    got = ranked(found, 4)
    for which in BOTH:
        assert got[which] == brute_lists(want, 4, which == "farthest")


def clustered(n, clusters, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, 8)) * 100
    return [(i, [float(v) for v in centres[i % clusters] + rng.normal(size=8)]) for i in range(n)]


def test_clustered_rows_are_mostly_pruned(spark):
    rows = clustered(3_000, 30, 2)
    vectors = stored(spark, rows, "long")
    found = ball_lists(vectors, 10, BOTH, ball_rows=50)
    full = nearest_and_farthest(vectors, 10)
    got = ranked(found, 10)
    for which in BOTH:
        assert got[which] == lists_of(full, which)
    assert found.compared < 0.2 * found.pairs


def test_clustered_rows_with_gaps(spark):
    rng = np.random.default_rng(6)
    rows = clustered(600, 12, 5)
    for i in range(0, 600, 9):
        rows[i][1][i % 8] = None
    rows[7] = (7, [None] * 8)
    for i in rng.integers(0, 600, 200):  # copies of one row
        rows[i] = (int(i), list(rows[1][1]))
    found = ball_lists(stored(spark, rows, "long"), 5, BOTH, ball_rows=25, max_rows=60)
    want = brute(rows)
    got = ranked(found, 5)
    for which in BOTH:
        assert got[which] == brute_lists(want, 5, which == "farthest")
    assert found.compared < found.pairs


def test_bounds_hold(spark):
    rng = np.random.default_rng(4)
    raw = rng.normal(size=(80, 5)) * 10 + 1000
    raw[rng.random(raw.shape) < 0.1] = np.nan
    pattern = np.array([True, True, False, True, True])
    hosts = rng.normal(size=(40, 5)) * 10 + 1000
    hosts[:, 2] = np.nan
    centre = hosts[:1][:, pattern]
    radius = np.sqrt(((hosts[:, pattern] - centre) ** 2).sum(axis=1)).max()
    ball = balls.Balls(pattern, centre, np.array([0, -1]), np.array([radius, np.inf]), np.array([40, 0]))
    low, high = balls.bounds(raw, ball)
    for x, least, most in zip(raw, low, high):
        diff = (hosts - x) ** 2
        used = (~np.isnan(diff)).sum(axis=1)
        if not used.any():
            assert np.isinf(least).all() and np.isinf(most).all()
            continue
        d = np.sqrt(np.nansum(diff, axis=1) * 5 / used)
        assert least[0] <= d.min() and d.max() <= most[0]
        assert np.isinf(least[1]) and np.isinf(most[1])


@pytest.mark.parametrize("rows", [[], [("a", [1.0])], [("a", [1.0]), ("b", [2.0])], [("a", [None]), ("b", [None])]])
def test_few_rows(spark, rows):
    got = ranked(ball_lists(stored(spark, rows), 3, BOTH), 3)
    assert got["nearest"] == ({"a": ["b"], "b": ["a"]} if len(rows) == 2 else {})


def test_repeated_keys_fail(spark):
    with pytest.raises(Exception, match="not unique"):
        ball_lists(stored(spark, [("a", [0.0]), ("a", [1.0])]), 2, ["nearest"])


def test_long_lists_of_rows_use_balls(spark, monkeypatch):
    from peerlens.operators import neighbours

    rows = clustered(400, 8, 3)
    vectors = stored(spark, rows, "long")
    want = lists_of(nearest_and_farthest(vectors, 3), "nearest")
    monkeypatch.setattr(neighbours, "BALLS_FROM", 300)
    monkeypatch.setattr(balls, "BALL_ROWS", 20)
    assert lists_of(nearest_and_farthest(vectors, 3), "nearest") == want


def test_rows_without_clusters_are_sent_once_a_set(spark):
    """Where hardly any ball can be ruled out, a row is copied once a set of balls and not once a ball."""
    rng = np.random.default_rng(9)
    raw = rng.normal(size=(3000, 12))
    rows = pa.array(range(3000)), pa.ListArray.from_arrays(pa.array(np.arange(0, 36001, 12), pa.int32()), pa.array(raw.ravel()))
    pattern = np.ones(12, bool)
    centres = raw[:300]
    ball = balls.Balls(pattern[None], [centres], np.arange(300), np.full(300, 50.0), np.full(300, 10))
    sets = balls.sets_of(ball, 1000)
    assert len(sets) == 3 and sets.size == 100
    none = pa.ListArray.from_arrays(pa.array(np.zeros(3001, int), pa.int32()), pa.array([], pa.int32()))
    batch = pa.RecordBatch.from_arrays([*rows, none, pa.array(np.full(3000, np.inf))], names=["key", "vec", "nearest", "nearest_limit"])
    sent = list(balls.visits(ball, sets, ["nearest"], len(balls.ROUND_ENDS))(iter([batch])))
    assert sum(b.num_rows for b in sent) == 3 * 3000
    assert sum(pc_sum(b) for b in sent) == 3000 * 3000
    # and no task holds the bounds of a whole batch to all balls
    assert max(b.num_rows for b in sent) <= 3 * balls.CELLS // 300


def pc_sum(batch):
    return sum(batch.column("pairs").to_pylist())


def test_each_common_pattern_has_balls(spark):
    """Rows that lack the same values are pruned like the others, not compared with all."""
    rows = clustered(3_000, 30, 7)
    for i in range(0, 3_000, 2):
        rows[i][1][3] = None
    vectors = stored(spark, rows, "long")
    found = ball_lists(vectors, 5, BOTH, ball_rows=50)
    full = nearest_and_farthest(vectors, 5)
    got = ranked(found, 5)
    for which in BOTH:
        assert got[which] == lists_of(full, which)
    assert found.compared < 0.4 * found.pairs


def test_limits_leave_no_cell_out():
    """Cells up to the limit stay, missing distances only where they rank first."""
    v = np.array([[1.0, 4.0, 4.0, np.nan, 9.0, np.nan]])
    error, limit = np.array([1e-12]), np.array([2.0])
    assert candidates(v, error, 2, False, limit)[1].tolist() == [0, 1, 2]
    assert candidates(v, error, 1, True, limit)[1].tolist() == [1, 2, 4, 5]
    assert candidates(v, error, 2, True, np.array([0.0]))[1].tolist() == [0, 1, 2, 3, 4, 5]
