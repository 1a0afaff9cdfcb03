import itertools
import math
import random

from peerlens.llm import spaced_seeds as s
from tests.llm.conftest import sentence


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def found(df):
    return sorted((r.doc_id, r.item_id) for r in s.leaked_documents(df).collect())


def plain(rows, items, least=13):
    """Exact copies only: documents that share ``least`` consecutive words (or all) with an item."""
    out = set()
    for key, text in rows:
        w = (text or "").lower().split()
        for item, other in enumerate(items):
            v = (other or "").lower().split()
            n = min(least, len(v))
            grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            if any(tuple(w[i : i + n]) in grams for i in range(len(w) - n + 1)):
                out.add((key, item))
    return sorted(out)


def test_exact_passages_agree_with_brute_force(spark):
    rng = random.Random(0)
    items = [sentence(rng, n, 3000) for n in (14, 20, 40, 59, 6, 1)]
    rows = [(i, sentence(rng, 120, 3000)) for i in range(40)]
    for i in range(0, 40, 3):
        cut = items[i % 4].split()
        rows[i] = (i, f"{rows[i][1][:200]} {' '.join(cut[:13 + i % (len(cut) - 12)])} {rows[i][1][200:]}")
    rows.append((100, "begin " + items[4] + " end"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [x for x in found(s.benchmark_leaks(docs, bench(spark, items))) if x[1] != 5]
    assert got == [x for x in plain(rows, items) if x[1] != 5]


def test_substituted_words_are_tolerated(spark):
    rng = random.Random(1)
    items = [sentence(rng, 45, 3000) for _ in range(20)]
    rows = []
    for i, item in enumerate(items):
        w = item.split()
        for place in range(4 + i % 5, len(w), 9):
            w[place] = "changed"
        rows.append((i, f"{sentence(rng, 50, 3000)} {' '.join(w)} {sentence(rng, 50, 3000)}"))
    leaks = s.benchmark_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench(spark, items))
    assert found(leaks) == [(i, i) for i in range(20)]
    assert all(r.n_words > r.n_same >= 35 for r in leaks.collect())


def lawful(flags):
    """The law itself: a stretch with enough agreeing words of which at most a fifth differ."""
    n = len(flags)
    least = min(13, math.ceil(0.8 * n))
    return any(
        sum(flags[i:j]) >= least and 5 * (j - i - sum(flags[i:j])) <= j - i for i in range(n) for j in range(i + 1, n + 1)
    )


def test_every_arrangement_that_is_a_leak_is_found(spark):
    rng = random.Random(4)
    items, rows, leaked = [], [], set()
    for n in range(1, 21):
        items.append([f"i{n}w{k}" for k in range(n)])
        for changed in range(min(n, 5)):
            places = list(itertools.combinations(range(n), changed))
            for some in places if len(places) <= 150 else rng.sample(places, 150):
                flags = [k not in some for k in range(n)]
                text = [w if same else f"x{len(rows)}" for w, same in zip(items[-1], flags)]
                around = ("", "") if len(rows) % 3 == 0 else (sentence(rng, 9), sentence(rng, 9))
                if lawful(flags):
                    leaked.add((len(rows), n - 1))
                rows.append((len(rows), f"{around[0]} {' '.join(text)} {around[1]}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = s.benchmark_leaks(docs, bench(spark, [" ".join(i) for i in items]))
    assert set(found(got)) == leaked and 2000 < len(leaked) < len(rows)


def test_long_overlaps_with_regular_changes(spark):
    rng = random.Random(5)
    item = [f"b{k}" for k in range(59)]
    rows = []
    for step in (4, 5, 6, 7):
        rows += [(len(rows) + i, " ".join("x" if k % step == i % step else w for k, w in enumerate(item))) for i in range(step)]
    for _ in range(300):
        some = rng.sample(range(59), 11)
        rows.append((len(rows), " ".join("x" if k in some else w for k, w in enumerate(item))))
    got = s.benchmark_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench(spark, [" ".join(item)]))
    expected = {(i, 0) for i, t in rows if lawful([w != "x" for w in t.split()])}
    assert set(found(got)) == expected and 300 < len(expected)


def test_one_overlap_is_described_where_it_is(spark):
    item = " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(7, f"x y {item.upper()}! z")], "doc_id long, text string")
    rows = [tuple(r) for r in s.benchmark_leaks(docs, bench(spark, [item])).collect()]
    assert rows == [(7, 0, 2, 0, 30, 30, 30)]


def test_parts_of_the_benchmark_give_the_same_as_the_whole(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(tuple(r) for r in s.benchmark_leaks(docs, items).collect())
    parts = sorted(tuple(r) for r in s.benchmark_leaks(docs, items, part_words=100).collect())
    assert whole == parts and whole


def test_clean_documents_stay(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    leaked = {k for k, _ in plain(rows, [r.text for r in sorted(items.collect())])}
    kept = s.without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in rows} - leaked and leaked


def test_edges(spark, edge_docs, no_docs):
    items = bench(spark, [None, "", "Hello", " ".join(f"w{i}" for i in range(20))])
    got = found(s.benchmark_leaks(edge_docs, items))
    assert got == [(4, 2), (5, 2)]
    kept = s.without_leaks(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 2
    assert s.benchmark_leaks(no_docs, items).collect() == []
    assert s.benchmark_leaks(edge_docs, bench(spark, [])).collect() == []
    assert s.without_leaks(edge_docs, bench(spark, [])).count() == edge_docs.count()
