"""Sampled silhouettes against exact ones, in numpy and by the exact operator."""

import numpy as np
import pytest

from peerlens.operators import silhouette_sample
from peerlens.operators.silhouette import silhouette_of_labels
from peerlens.operators.silhouette_sample import mean_silhouette, pivot_count, sample_weight, sampled_silhouettes

SF = "/root/testdata/sf0.1"


def plain(x, labels):
    """Widths of all points by the definition."""
    far = np.sqrt(np.maximum(((x[:, None, :] - x[None, :, :]) ** 2).sum(2), 0))
    out = np.zeros(len(x))
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1 or len(set(labels)) == 1:
            continue
        a = far[i, mine].sum() / (mine.sum() - 1)
        b = min(far[i, labels == o].mean() for o in set(labels) - {own})
        out[i] = (b - a) / max(a, b) if max(a, b) > 0 else 0.0
    return out


def table(spark, x, labels, kind="int"):
    rows = [(i, v.tolist(), c) for i, (v, c) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, f"key long, vec array<double>, label {kind}").repartition(4)


def test_small_clusters_are_exact_and_equal_the_exact_operator(spark):
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(0, 1, (60, 5)), rng.normal(3, 1, (40, 5)), [[9.0] * 5], np.zeros((5, 5))]
    labels = [None] * 60 + ["a"] * 40 + ["one"] + ["same"] * 5
    points = table(spark, x, labels, "string")
    got = {r.key: r for r in sampled_silhouettes(points, "label").collect()}
    want = {r.key: r for r in silhouette_of_labels(points, "label").collect()}
    numbers = np.array([str(c) for c in labels])
    for i, w in enumerate(plain(x, numbers)):
        assert got[i].label == labels[i] and got[i].low == got[i].width == got[i].high
        assert got[i].width == pytest.approx(w, abs=1e-9) and want[i].width == pytest.approx(w, abs=1e-9)


@pytest.mark.parametrize("seed", [1, 2])
def test_intervals_hold_on_drawn_clusters(spark, seed):
    rng = np.random.default_rng(seed)
    # One large cluster with a far-off minority (an even sample would miss it), a middling and a small one.
    x = np.r_[rng.normal(0, 1, (4000, 3)), rng.normal(400, 1, (6, 3)), rng.normal(6, 1, (2500, 3)), rng.normal(-9, 2, (50, 3))]
    labels = np.array([0] * 4006 + [1] * 2500 + [2] * 50)
    n = len(x)
    t = sample_weight(n, 3, 0.5, 0.05)
    assert 50 < t < 2500 and pivot_count(n, 3, 0.05) < 30
    got = sorted(sampled_silhouettes(table(spark, x, labels.tolist()), "label", 0.5, 0.05, seed).collect())
    want = plain(x, labels)
    low, width, high = (np.array([r[c] for r in got]) for c in ("low", "width", "high"))
    assert (low <= want + 1e-9).all() and (want <= high + 1e-9).all()
    assert (high - low)[labels < 2].min() > 0
    assert np.abs(width - want).max() < 0.25 and abs(width.mean() - want.mean()) < 0.02


def test_embeddings_within_their_bound(spark):
    points = spark.read.parquet(f"{SF}/embeddings.parquet").selectExpr("vec_id AS key", "embedding AS vec", "label % 2 AS label")
    assert points.count() / 2 > 4 * sample_weight(points.count(), 2, 0.9, 0.5)  # both clusters are sampled
    found = sampled_silhouettes(points, "label", epsilon=0.9, delta=0.5).join(
        silhouette_of_labels(points, "label").selectExpr("key", "width AS exact"), "key"
    )
    off = found.selectExpr("count(*) AS n", "count_if(exact BETWEEN low - 1e-9 AND high + 1e-9) AS held", "avg(abs(width - exact)) AS error").first()
    assert off.n == off.held > 0 and 0 < off.error < 0.1


def test_edges(spark):
    empty = table(spark, np.zeros((1, 2)), [0]).limit(0)
    assert sampled_silhouettes(empty, "label").collect() == []
    one = sampled_silhouettes(table(spark, np.ones((3, 2)), [7] * 3), "label")
    assert [tuple(r)[1:] for r in one.collect()] == [(7, 0.0, 0.0, 0.0)] * 3
    assert tuple(mean_silhouette(one).first()) == (0.0, 0.0, 0.0)
    copies = table(spark, np.repeat([[0.0], [1.0]], 2000, axis=0), [0] * 2000 + [1] * 2000)
    assert {tuple(r)[2:] for r in sampled_silhouettes(copies, "label", 0.9).collect()} == {(1.0, 1.0, 1.0)}
    with pytest.raises(ValueError, match="labels"):
        sampled_silhouettes(table(spark, np.zeros((1001, 1)), list(range(1001))), "label")
    with pytest.raises(ValueError, match="epsilon"):
        sampled_silhouettes(empty, "label", epsilon=1.5)
    gap = spark.createDataFrame([(1, [1.0, None], 0), (2, [1.0, 2.0], 1)], "key long, vec array<double>, label int")
    with pytest.raises(Exception, match="missing values"):
        sampled_silhouettes(gap, "label").collect()


def test_a_task_holds_small_tiles_only(tmp_path):
    """Distances of a batch to the samples are made in tiles of a few MB, whatever the sizes of both."""
    import tracemalloc

    import pyarrow as pa
    import pyarrow.parquet as pq

    def vectors(n):
        return pa.FixedSizeListArray.from_arrays(pa.array(np.random.default_rng(n).normal(size=2 * n)), 2).cast(pa.list_(pa.float64()))

    own = [pa.array(np.arange(n) % 2) for n in (6000, 4096)]
    pq.write_table(pa.table({"own": own[0], "vec": vectors(6000), "p": pa.array(np.ones(6000))}), tmp_path / "a.parquet")
    batch = pa.RecordBatch.from_arrays([pa.array(range(4096)), own[1], vectors(4096)], names=["key", "own", "vec"])
    tracemalloc.start()
    [found] = silhouette_sample._estimates(str(tmp_path), [3000, 3000], [0.5, 0.5])(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 4096 and peak < 64 << 20
