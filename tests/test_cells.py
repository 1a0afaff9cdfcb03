"""Neighbour lists by cells against a plain double loop and the full comparison."""

import numpy as np
import pyarrow as pa
import pytest

from peerlens.operators import cells, neighbours
from peerlens.operators.cells import cell_lists
from peerlens.operators.neighbours import nearest_and_farthest
from peerlens.sources.staging import stage
from tests.test_distance import brute, brute_lists, rows_with_everything

BOTH = ["nearest", "farthest"]


def stored(spark, rows, kind="string"):
    return stage(spark.createDataFrame(rows, f"key {kind}, vec array<double>"), "test")


def ordered(df):
    """Every list with its distances, in the order of the places."""
    out = {which: {} for which in BOTH}
    for r in sorted(df.collect(), key=lambda r: r.place):
        assert r.place == len(out[r.list].setdefault(r.orig, [])) + 1
        out[r.list][r.orig].append((r.dest, r.distance))
    return out


def check(df, rows, k):
    want, got = brute(rows), ordered(df)
    for which in BOTH:
        lists = brute_lists(want, k, which == "farthest")
        assert {orig: [dest for dest, _ in found] for orig, found in got[which].items()} == lists
        for orig, found in got[which].items():
            for dest, d in found:
                assert (d is None and want[orig, dest] is None) or abs(d - want[orig, dest]) < 1e-9


@pytest.mark.parametrize("cell_rows, leaf_rows, max_rows", [(16384, 128, 32768), (20, 4, 32768), (30, 7, 9)])
def test_lists_with_missing_values_and_copies(spark, monkeypatch, cell_rows, leaf_rows, max_rows):
    monkeypatch.setattr(cells, "LEAF_ROWS", leaf_rows)
    rows = rows_with_everything(180, 6, 1)
    check(cell_lists(stored(spark, rows), 4, BOTH, cell_rows, max_rows), rows, 4)


def test_copies_and_almost_copies(spark):
    """Many copies, of rows without any value too, beside rows that differ by less than a rank."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(60)]
    rows += [(1000 - i, [0.5, None, 0.25]) for i in range(40)]
    rows += [(500 + i, [0.5 + (i % 3) * 1e-11, None, 0.25]) for i in range(30)]
    rows += [(2000 + i, [None, None, None]) for i in range(15)]
    check(cell_lists(stored(spark, rows, "long"), 3, BOTH, cell_rows=25, max_rows=40), rows, 3)


def test_many_rows_of_few_features_go_by_cells(spark, monkeypatch):
    """Before, they went by balls, which visit a large share of all rows in any number of dimensions."""
    rng = np.random.default_rng(4)
    rows = [(None if i == 7 else f"K{i}", [float(v) for v in rng.normal(size=4)]) for i in range(600)]
    for i in range(0, 600, 11):
        rows[i][1][i % 4] = None
    rows[5] = ("K5", [None] * 4)  # at no distance of any row, so the keys decide
    vectors = stored(spark, rows)
    want = {tuple(r) for r in nearest_and_farthest(vectors, 3).collect()}
    called = []
    monkeypatch.setattr(neighbours, "BALLS_FROM", 500)
    monkeypatch.setattr(neighbours.balls, "ball_lists", lambda *a: called.append("balls"))
    monkeypatch.setattr(cells, "CELL_ROWS", 64)
    assert {tuple(r) for r in nearest_and_farthest(vectors, 3).collect()} == want
    assert not called


def test_rows_of_one_place_visit_few_cells():
    rng = np.random.default_rng(5)
    raw = rng.random((20_000, 4))
    tree = cells.plant(raw[::16], [15], 16, 500)
    batch = as_batch(raw)
    at = next(cells.to_cells(tree)(iter([batch]))).column("cell").to_numpy()
    assert tree.cells >= 40 and np.bincount(at, minlength=tree.cells).max() < 1_500
    low, high = (np.array([f(raw[at == i], axis=0) for i in range(tree.cells)]) for f in (np.min, np.max))
    boxes = cells.Boxes(low, high, np.ones(low.shape, bool), np.bincount(at, minlength=tree.cells))
    near = as_batch(raw, cell=at, bound=np.full(len(raw), 0.05), seen=np.full(len(raw), -1))
    gone = sum(len(r) for _, r, _ in cells.near_visits(boxes, {}, 2)(iter([near])))
    assert gone < 3 * len(raw)
    middle = raw.mean(axis=0)
    outer = cells.farthest_rows(raw, raw[:64], middle, 10)[0]
    limits = [r for b in cells.far_limits(boxes, [15], outer, middle, 10)(iter([near])) for r in b.to_pylist()]
    least, need = np.full(tree.cells, np.inf), {15: np.full(tree.cells, np.inf)}
    for r in limits:
        least[r["cell"]] = min(least[r["cell"]], r["bound"])
        need[15][r["cell"]] = min(need[15][r["cell"]], r["need"])
    gone = sum(len(r) for _, r, _ in cells.far_visits(boxes, least, need, middle)(iter([near])))
    assert gone < 4 * len(raw)  # of 40 cells and more


def as_batch(raw, **columns):
    ends = pa.array(np.arange(0, raw.size + 1, raw.shape[1]), pa.int32())
    vec = pa.ListArray.from_arrays(ends, pa.array(raw.ravel()))
    values = [pa.array(np.arange(len(raw))), vec, *(pa.array(x) for x in columns.values())]
    return pa.RecordBatch.from_arrays(values, names=["key", "vec", *columns])


@pytest.mark.parametrize("rows", [[("a", [1.0, 2.0]), ("a", [3.0, 4.0])], [("a", [1.0, 2.0]), ("b", [3.0])], [("a", [1.0, 2.0]), ("b", None)]])
def test_repeated_keys_and_odd_vectors_fail(spark, rows):
    with pytest.raises(ValueError, match="not unique|differ in length"):
        cell_lists(stored(spark, rows), 3, BOTH)


def test_few_rows(spark):
    assert cell_lists(stored(spark, []), 3, BOTH).collect() == []
    assert cell_lists(stored(spark, [("a", [1.0])]), 3, BOTH).collect() == []
    check(cell_lists(stored(spark, rows := [("a", [1.0, None]), ("b", [None, 2.0]), ("c", [4.0, 1.0])]), 3, BOTH), rows, 3)
