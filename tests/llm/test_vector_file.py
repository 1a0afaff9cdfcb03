import math
import random

import pytest

from peerlens.llm.vector_file import top_k


def plain(rows, asks, k):
    vectors = [
        (key, [math.floor(256 * x) for x in v])
        for key, v in rows
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, (q, a) in enumerate(vectors):
        if asks(q):
            others = [(c, b) for j, (c, b) in enumerate(vectors) if j != i and len(b) == len(a)]
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in others)
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1.0, 3) for r in rows], "vec_id long, embedding array<double>, score double, rank int")


@pytest.mark.parametrize("blocks", [(4096, 1024), (37, 5)])
def test_random_vectors_with_ties(spark, blocks):
    rng = random.Random(blocks[0])
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.5, rng.random()]) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)]  # a group of copies
    got = top_k(frame(spark, rows), "vec_id % 7 = 0", 5, block_rows=blocks[0], query_rows=blocks[1])
    assert found(got) == plain(rows, lambda q: q % 7 == 0, 5)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [2.0, -1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [1.0, None]), (None, [1.0, 1.0]),
        (6, [0.001, -0.001]), (7, [1.0]), (8, []), (9, []), (10, [5.0, 5.0, 5.0]), (11, [1e9, -1e9]), (12, [0.0, 0.0]),
    ]
    assert found(top_k(frame(spark, rows), "vec_id >= 0", 5)) == plain(rows, lambda q: True, 5)
    assert found(top_k(frame(spark, rows[:1]), "vec_id >= 0", 5)) == []
    assert found(top_k(frame(spark, rows).limit(0), "vec_id >= 0", 5)) == []


def test_products_beyond_double_precision_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1e5, 1e5) for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, [1e6 + i, 1e6, -1e6, 1e5]) for i in range(40)]
    assert found(top_k(frame(spark, rows), "vec_id % 3 = 0", 5)) == plain(rows, lambda q: q % 3 == 0, 5)


def test_rows_that_repeat_an_id_stand_for_themselves(spark):
    rows = [(50, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [5.0, 1.0]), (50, [2.0, 0.0]), (2, [0.5, 0.5]), (1, [5.0, 1.0])]
    got = found(top_k(frame(spark, rows), "vec_id = 50", 5))
    assert got == plain(rows, lambda q: q == 50, 5)
    assert (50, 1, 1, 5 * 256 * 256) in got and len(got) == 10
    hot = [(50 + i % 3 // 2 * i, [float(i % 7), 1.0]) for i in range(600)]  # two thirds of the rows have one id
    assert found(top_k(frame(spark, hot), "vec_id = 100", 5, block_rows=50)) == plain(hot, lambda q: q == 100, 5)


def test_twin_on_repeated_ids(spark):
    import duckdb
    import pandas as pd

    from peerlens.llm.queries import ORACLES

    rows = [(i % 70, [float(i % 5), float(i % 11), -1.0]) for i in range(150)]
    embeddings = pd.DataFrame(rows, columns=["vec_id", "embedding"])  # read by the twin
    assert len(embeddings) == 150
    twin = duckdb.sql(ORACLES["op8_vector_file_search"]).fetchall()
    assert found(top_k(frame(spark, rows), "vec_id % 50 = 0", 5)) == sorted(twin)


def test_float_column(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    assert found(top_k(vectors, "vec_id % 50 = 0", 5)) == plain(rows, lambda q: q % 50 == 0, 5)
