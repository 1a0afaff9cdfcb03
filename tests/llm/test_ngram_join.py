import random
from collections import defaultdict

import pytest

from peerlens.llm import ngram_join
from peerlens.llm.ngram_join import ngram_groups, one_of_each_group
from peerlens.llm.store import components
from tests.llm.conftest import sentence, words


def plain(rows, size=5, percent=75):
    """``[(id, size of the set, component, links)]``, every pair of rows compared."""
    sets = []
    for key, text in rows:
        w = words(text)
        sets.append((key, {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()))
    parent = {k: k for k, _ in sets if k is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = defaultdict(int)
    for i, (a, s) in enumerate(sets):
        for j in range(i + 1, len(sets)):
            b, t = sets[j]
            if a is None or b is None or not s or not t:
                continue
            both = len(s & t)
            if 100 * both >= percent * (len(s) + len(t) - both):
                links[i] += 1
                links[j] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    out = [(k, len(s), None if k is None else root(k), links[i]) for i, (k, s) in enumerate(sets)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies(rng, groups, copies, length):
    rows, key = [], 0
    for _ in range(groups):
        base = sentence(rng, length).split()
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"new{rng.randrange(50)}"
            rows.append((key, " ".join(own)))
            key += 1
    return rows


def test_edges(spark, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert found(ngram_groups(edge_docs)) == plain(rows)


def test_empty_table(no_docs):
    assert ngram_groups(no_docs).collect() == []
    assert one_of_each_group(no_docs).collect() == []


@pytest.mark.parametrize("block", [3, 512])
def test_near_copies_lose_no_link_however_components_are_cut(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(block)
    rows = near_copies(rng, 6, 14, 60) + [(1000 + i, sentence(rng, 40)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(ngram_groups(docs)) == plain(rows)


def test_sizes_that_allow_a_link_meet_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[: 60 + 4 * i])) for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(ngram_groups(docs)) == plain(rows)


def test_a_third_of_all_rows_are_copies(spark):
    rng = random.Random(1)
    base = sentence(rng, 50)
    rows = [(i, base) for i in range(400)] + [(1000 + i, sentence(rng, 50)) for i in range(800)]
    got = {r[0]: r[1:] for r in found(ngram_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)))}
    assert all(got[i] == (46, 0, 399) for i in range(400))
    assert all(got[1000 + i][1:] == (1000 + i, 0) for i in range(800))


def test_stage_keeps_columns_and_the_smallest_id(edge_docs):
    kept = one_of_each_group(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 2, 3, 4, 6, 9, 11, 12, 13, *range(20, 32), None, None]


def test_components_of_paths_stars_and_self_edges(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(500, 500 + i) for i in range(1, 80)] + [(900, 900)]
    rng.shuffle(edges)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {500 + i: 500 for i in range(80)}


def test_rows_that_repeat_an_id_go_by_their_own_text(spark):
    a, b = ("alpha beta gamma delta epsilon zeta", "one two three four five six seven")
    rows = [(1, a), (5, a), (5, b), (5, b), (7, b + " eight"), (None, a), (9, ""), (9, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, place int").repartition(3)
    kept = one_of_each_group(docs)
    assert kept.columns == ["doc_id", "text", "place"]
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (5, b), (None, a), (9, ""), (9, None)], key=str)


@pytest.mark.parametrize("percent", [30, 50, 90, 100])
def test_other_shares_than_the_usual_one(spark, monkeypatch, percent):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rng = random.Random(percent)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[: 200 - 6 * i])) for i in range(30)]  # 196 and 106 shingles sharing 106 among them
    rows += [(100 + k, t) for k, t in near_copies(rng, 3, 5, 40)] + [(300, " ".join(base[:110]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(ngram_groups(docs, percent=percent)) == plain(rows, percent=percent)
