import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from peerlens.llm import passage_quality as q
from peerlens.llm.words import texts_of


def test_every_word_is_in_one_passage_and_shares_are_shares():
    texts = next(texts_of(pa.array(["a b " * 70, None, "", "***", " x"]), lower=False))
    x, first = q.encode(texts)
    assert np.diff(first).tolist() == [3, 1, 1, 1, 1]
    assert np.isfinite(x).all()
    assert (x[first[1], : q.SHAPES][[0, 6]] == 0).all() and x[first[1], 14] == 1
    assert x[first[3], 6] == 1.0


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    x, first, y = rng.normal(size=(9, 6)), np.array([0, 3, 4, 9]), np.array([1, 0, 1])
    start = q.train(x, first, y, rounds=0)
    weight = np.where(y > 0, 0.25, 0.5)

    def loss(m):
        p = q.score(m, x, first)
        return -(weight * np.where(y > 0, np.log(p), np.log(1 - p))).sum()

    before = {n: getattr(start, n).copy() for n in q.LEARNED}
    after = q.train(x, first, y, rounds=1, decay=0.0)  # one step of Adam goes against the gradient's sign
    for name in q.LEARNED:
        step = getattr(after, name) - before[name]
        for index in list(np.ndindex(step.shape))[:6]:
            value = getattr(start, name)
            value[index] += 1e-5
            up = loss(start)
            value[index] -= 2e-5
            slope = (up - loss(start)) / 2e-5
            value[index] += 1e-5
            if abs(slope) > 1e-6:
                assert np.sign(step[index]) == -np.sign(slope), (name, index)


def test_held_out_accuracy(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    rows = q.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in rows)
    bad = [r for r in rows if r.quality == 0]
    assert len(bad) > 8
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert sum(r.predicted == 0 for r in bad) / len(bad) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_held_out_labels_and_other_columns_do_not_matter(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    changed = labels.withColumn("quality", F.when(q.held_out(1, 3), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = sorted(map(tuple, q.quality_scores(docs, labels).collect()))
    b = sorted(map(tuple, q.quality_scores(docs.withColumn("lang", F.lit("x")).drop("source"), changed).collect()))
    assert a == b


def test_edges(spark, small, edge_docs, no_docs):
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (4, 7), (10**6, 0)], "doc_id long, quality int"
    )
    rows = q.quality_scores(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert q.quality_scores(no_docs, labels).collect() == []
    one_sided = labels.where("quality = 1")
    assert {(r.score, r.predicted) for r in q.quality_scores(edge_docs, one_sided).collect()} == {(0.5, 1)}
    assert len(q.quality_scores(edge_docs, labels.limit(0)).collect()) == len(rows)
