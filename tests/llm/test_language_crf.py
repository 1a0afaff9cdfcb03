import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from peerlens.llm import language_crf as crf
from peerlens.llm.words import texts_of


def model(k=3, seed=0):
    rng = np.random.default_rng(seed)
    return crf.Model(
        [f"l{i}" for i in range(k)], rng.normal(size=(crf.SLOTS, k)).astype(np.float32), np.zeros(0, np.uint64),
        np.zeros((1, k), np.float32), rng.normal(size=(k, k)), rng.normal(size=k),
    )


def test_forward_backward_is_the_sum_over_all_labelings():
    m, k = model(), 3
    scores = np.random.default_rng(1).normal(size=(6, k)).astype(np.float32)
    first = np.array([0, 4, 4, 6])
    got = crf.posteriors(scores, first, m)
    for a, b in zip(first[:-1], first[1:]):
        total = np.zeros((b - a, k))
        for labels in itertools.product(range(k), repeat=b - a):
            if labels:
                e = m.start[labels[0]] + sum(scores[a + t, y] for t, y in enumerate(labels))
                e += sum(m.transitions[x, y] for x, y in zip(labels, labels[1:]))
                total[np.arange(b - a), list(labels)] += np.exp(e)
        if b > a:
            assert np.allclose(got[a:b], total / total.sum(axis=1, keepdims=True), atol=1e-5)


def test_the_learning_step_is_the_gradient():
    m, k, n = model(seed=2), 3, 2
    rng = np.random.default_rng(3)
    spread, gold = rng.normal(size=(n, 5, k)), rng.integers(0, k, (n, 5))

    def loss(transitions, spread):
        total = 0.0
        for s, g in zip(spread, gold):
            def weight(y):
                return m.start[y[0]] + sum(s[t, v] for t, v in enumerate(y)) + sum(transitions[a, b] for a, b in zip(y, y[1:]))
            total += np.log(sum(np.exp(weight(y)) for y in itertools.product(range(k), repeat=5))) - weight(list(g))
        return total

    excess, moved, _ = crf._learn_step(m, spread.copy(), gold)
    for index in [(0, 1, 2), (1, 4, 0)]:
        d = np.zeros_like(spread)
        d[index] = 1e-5
        assert abs((loss(m.transitions, spread + d) - loss(m.transitions, spread - d)) / 2e-5 - excess[index]) < 1e-4
    d = np.zeros((k, k))
    d[1, 2] = 1e-5
    assert abs((loss(m.transitions + d, spread) - loss(m.transitions - d, spread)) / 2e-5 - moved[1, 2]) < 1e-4


def test_code_switched_words_get_their_own_language():
    rng = np.random.default_rng(0)
    parts = {"x": ["ab", "abba", "baba", "aab"], "y": ["uvo", "vuvu", "ovu", "uuv"]}
    texts = [" ".join(rng.choice(parts[y], 60)) for y in "xy" * 20]
    m = crf.train(texts, ["x", "y"] * 20, rounds=30)
    switched = " ".join(rng.choice(parts["x"], 10)) + " " + " ".join(rng.choice(parts["y"], 10))
    block = next(texts_of(pa.array([switched])))
    words = crf.letter_runs(block)
    got = crf.posteriors(m.word_scores(words)[0], words.first, m).argmax(axis=1)
    assert got.tolist() == [0] * 10 + [1] * 10


def test_held_out_accuracy(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    rows = crf.language_of(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    other = docs.withColumn("lang", F.when(crf.held_out(2, 4), F.lit("zz")).otherwise(F.col("lang"))).withColumn(
        "source", F.lit("s")
    )
    a, b = (sorted(map(tuple, crf.language_of(d).collect())) for d in (docs, other))
    assert a == b


def test_edges(spark, small, edge_docs):
    training = spark.read.parquet(f"{small}/documents.parquet")
    rows = crf.language_of(edge_docs, training).collect()
    assert len(rows) == edge_docs.count()
    got = {r.doc_id: r for r in rows}
    for key in (1, 2, 3, 11):
        assert (got[key].lang_pred, got[key].score) == ("und", 0.0)
    assert got[12].lang_pred != "und" and got[9].lang_pred != "und"
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    kept = crf.in_known_language(edge_docs, 0.0)
    assert kept.columns == edge_docs.columns and 0 < kept.count() < len(rows)


def test_no_rows_or_no_labels(no_docs, edge_docs):
    assert crf.language_of(no_docs).collect() == []
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in crf.language_of(unlabelled).collect()} == {"und"}
    assert crf.in_known_language(no_docs).collect() == []


def test_a_repeated_line_does_not_outvote_the_rest(spark, small):
    training = spark.read.parquet(f"{small}/documents.parquet")
    german = max((r.text for r in training.where("lang = 'de'").collect()), key=len)[:2000]
    docs = spark.createDataFrame([(1, german + " the and of" * 3000, None)], "doc_id long, text string, lang string")
    assert crf.language_of(docs, training).first().lang_pred == "de"
