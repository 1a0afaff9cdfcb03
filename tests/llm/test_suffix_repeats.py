import random
from collections import defaultdict

import pytest

from peerlens.llm import suffix_repeats as s
from tests.llm.conftest import sentence, words


def plain(rows, length):
    """Union of the runs of ``length`` words that another row has too."""
    where = defaultdict(set)
    cut = [words(t) for _, t in rows]
    for i, w in enumerate(cut):
        for k in range(len(w) - length + 1):
            where[tuple(w[k : k + length])].add(i)
    out = []
    for i, w in enumerate(cut):
        spans = []
        for k in range(len(w) - length + 1):
            if len(where[tuple(w[k : k + length])]) > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + length
                else:
                    spans.append([k, k + length])
        out += [(rows[i][0], a, b) for a, b in spans]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def planted(rng, n):
    shared = [sentence(rng, m, 5000) for m in (48, 49, 50, 51, 80, 200)]
    rows = []
    for i in range(n):
        parts = [sentence(rng, rng.randrange(90), 5000) for _ in range(3)]
        for part in rng.sample(range(len(shared)), 2):
            parts.insert(rng.randrange(4), shared[part])
        rows.append((i, "\n".join(parts)))
    return rows


def test_planted_passages(spark, monkeypatch):
    monkeypatch.setattr(s, "BUCKET_WORDS", 500)
    rows = planted(random.Random(2), 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(s.repeated_passages(docs)) == plain(rows, 50)


def test_suffixes_that_very_many_rows_have(spark):
    rng = random.Random(3)
    passage = sentence(rng, 60, 5000)
    rows = [(i, f"{sentence(rng, 15, 5000)} {passage} {sentence(rng, 15, 5000)}") for i in range(1500)]
    rows += [(2000 + i, sentence(rng, 60, 5000)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = found(s.repeated_passages(docs))
    assert got == plain(rows, 50) and len(got) == 1500


def test_copies_and_texts_that_repeat_themselves(spark):
    rng = random.Random(4)
    once, own, mono = sentence(rng, 70), sentence(rng, 55), " ".join(["the"] * 130)
    rows = [(1, once), (2, once.upper()), (3, f"{own} {own}"), (4, mono), (5, mono + " the the end"), (6, sentence(rng, 400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    assert found(s.repeated_passages(docs)) == plain(rows, 50)


def test_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert found(s.repeated_passages(edge_docs)) == plain(rows, 50)
    assert s.repeated_passages(no_docs).collect() == []
    twice = spark.createDataFrame([(None, sentence(random.Random(9), 60))] * 2, "doc_id long, text string")
    assert found(s.repeated_passages(twice)) == [(None, 0, 60), (None, 0, 60)]
    with pytest.raises(ValueError):
        s.repeated_passages(edge_docs, length=20)


def test_longest_length_that_a_byte_of_runs_allows(spark):
    rng = random.Random(9)
    top = s.ANCHOR + 254
    shared = sentence(rng, top + 5, 5000)
    rows = [(i, f"{sentence(rng, 20, 5000)} {shared} {sentence(rng, 9, 5000)}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert found(s.repeated_passages(docs, top)) == plain(rows, top)
    with pytest.raises(ValueError, match="254"):
        s.repeated_passages(docs, top + 1)
