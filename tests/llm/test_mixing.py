import random

import duckdb
import pytest

from peerlens.llm import mixing, oracles
from tests.llm.conftest import sentence, words


def poured(sizes, weights, total):
    """Targets by resharing the excess round after round."""
    capped = set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        open_ = [s for s in sizes if s not in capped]
        over = {s for s in open_ if weights[s] * left / sum(weights[x] for x in open_) > 2 * sizes[s] + 1e-9}
        if not over:
            return {s: 2 * sizes[s] if s in capped else weights[s] * left / sum(weights[x] for x in open_) for s in sizes}
        capped |= over


def by_source(rows):
    out = {}
    for r in rows:
        source = r["row"]["source"]
        x = out.setdefault(source, {"size": 0, "taken": 0, "target": r.target, "most": 0, "source_size": r.source_size})
        x["size"] += r["size"]
        x["taken"] += r.taken
        x["most"] = max(x["most"], r["size"])
    return out


def documents(rng, sources):
    rows = [(i, sentence(rng, rng.choice([1, 5, 40, 80])), s) for i, s in enumerate(sources)]
    return rows + [(10_000 + i, None, "s1") for i in range(5)]


@pytest.mark.parametrize("bins", [1, 7, 4096])
def test_targets_and_budgets_hold_for_any_bins(spark, monkeypatch, bins):
    monkeypatch.setattr(mixing, "BINS", bins)
    rng = random.Random(bins)
    names = ["s1", "s2", "S3", "é", None, "z"]
    rows = documents(rng, [rng.choice(names + ["s1"] * 5) for _ in range(600)])
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    assert len(got) == len(rows)
    totals = by_source(got)
    order = ["S3", "s1", "s2", "z", "é", None]
    weights = {s: [3, 1, 2][i % 3] for i, s in enumerate(order)}
    targets = poured({s: totals[s]["size"] for s in order}, weights, 1.5 * sum(t["size"] for t in totals.values()))
    for s, t in totals.items():
        assert t["source_size"] == t["size"]
        assert t["target"] == pytest.approx(targets[s])
        assert abs(t["taken"] - t["target"]) <= t["most"] / 2 + 1e-6
    assert all(r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"] for r in got)


def test_bins_do_not_change_who_is_taken(spark, monkeypatch, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    results = []
    for bins in (1, 4096):
        monkeypatch.setattr(mixing, "BINS", bins)
        results.append(sorted(tuple(r) for r in mixing.mix(docs.repartition(3)).drop("row").collect()))
    assert results[0] == results[1]


def test_agrees_with_plain_window_sums(spark, small):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(duck.execute(oracles.MIX).fetchall())
    got = mixing.mix(spark.read.parquet(f"{small}/documents.parquet")).drop("row")
    got = got.select("doc_id", "size", "source_size", "target", "copies", "taken").collect()
    assert [tuple(r[:3]) + tuple(r[4:]) for r in sorted(got)] == [r[:3] + r[4:] for r in want]
    assert [r.target for r in sorted(got)] == pytest.approx([r[3] for r in want])


def test_better_documents_are_drawn_first(spark):
    rows = [(i, sentence(random.Random(i), 30), "a") for i in range(300)]
    rows += [(1000 + i, " ".join("x***" for _ in range(30)), "a") for i in range(300)]
    rows += [(5000 + i, sentence(random.Random(i), 30), "b") for i in range(600)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=0.5).collect()
    taken = [r for r in got if r["row"]["source"] == "a"]
    copies = [sum(r.copies for r in taken if (r.doc_id < 1000) == clean) for clean in (True, False)]
    assert copies[0] > 1.5 * copies[1] > 0


def test_edges(spark, edge_docs, no_docs):
    got = mixing.mix(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert all(r["size"] == len(words(r["row"]["text"])) for r in got)
    assert all(r.copies == 0 or r["size"] >= 0 for r in got)
    mixed = mixing.mixture(edge_docs)
    assert mixed.columns == edge_docs.columns
    assert mixed.count() == sum(r.copies for r in got if r["size"])
    assert mixing.mix(no_docs).collect() == [] and mixing.mixture(no_docs).collect() == []
    blank = edge_docs.where("doc_id IN (1, 2, 3)")
    assert {(r["size"], r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0, 0.0, 0)}


def test_only_built_in_functions(spark, small):
    plan = mixing.mix(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))
