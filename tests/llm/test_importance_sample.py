"""Importance sampling against a plain version that hashes every feature by itself."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from peerlens.llm import importance_sample as S
from peerlens.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def features(text):
    w = WORD.findall((text or "").translate(SMALL))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])], len(w)


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def plain(rows, target):
    s, t = (Counter(bucket(f) for x in texts for f in features(x)[0]) for texts in ([r[1] for r in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in {*s, *t}
    }
    out = []
    for doc, text in rows:
        fs, n = features(text)
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(fs), weight, score, None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: 25 * len(able) // 100]):
        r[4] = rank + 1
    return [tuple(r) for r in out]


def key(row):
    return tuple((v is None, v or 0) for v in row)


def same(found, expected):
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


@pytest.fixture(autouse=True)
def small_head(monkeypatch):
    """A head that leaves most features to the tail."""
    monkeypatch.setattr(S, "HEAD_WORDS", 40)
    monkeypatch.setattr(S, "HEAD_PAIRS", 60)
    monkeypatch.setattr(S, "BLOCK_BYTES", 1 << 12)


def texts(rng, n):
    words = [f"w{i}" for i in range(300)] + ["Été", "日本", "A", "x_y", "don't", "\x7f", "3.5", "é" * 80]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randrange(60))) for _ in range(n)]


def test_equals_plain_version(spark):
    rng = random.Random(1)
    rows = list(enumerate(texts(rng, 400)))
    target = [*texts(rng, 30), None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    same(S.importance_sample(docs, wanted).collect(), plain(rows, target))


def test_edge_rows(spark, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    target = ["w1 w2 w3", "über straße"]
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    same(S.importance_sample(edge_docs, wanted).collect(), plain(rows, target))


def test_no_documents_and_no_target(spark, no_docs, edge_docs):
    assert S.importance_sample(no_docs, no_docs).collect() == []
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    same(S.importance_sample(edge_docs, no_docs).collect(), plain(rows, []))


def test_cut_texts_lose_no_pair(monkeypatch):
    rng = random.Random(4)
    text = " ".join(texts(rng, 40)) + "é" * 3_000 + " " * 400 + "end"
    column = pa.array(["first", text, None, "last one"])
    got = Counter()
    for block, again in S.blocks(column, 256):
        names = [w.decode() for w in block.distinct]
        got.update((t, names[i]) for t, i in zip(block.text[again:].tolist(), block.word[again:].tolist()))
        for place, pair in zip(block.joined, block.pair):
            got[int(block.text[place]), f"{names[block.first[pair]]} {names[block.second[pair]]}"] += 1
    assert got == Counter((i, f) for i, t in enumerate(column.to_pylist()) for f in features(t)[0])


def test_head_and_tail_agree(monkeypatch):
    block = next(S.blocks(pa.array(["a b c a b é", "b c d"])))[0]
    full = S.Head([], [], 10_000).hashed(block)
    for words, pairs in (([b"a", b"b"], []), ([], [b"a b", b"b c"]), ([b"a", b"d"], [b"c d"])):
        for x, y in zip(full, S.Head(words, pairs, 10_000).hashed(block)):
            assert np.array_equal(x, y)


def test_ranks_of_equal_rows(spark):
    """A third of all rows are copies of one row: each is drawn on its own and no rank is given twice."""
    rows = [(1, "same " * 30)] * 400 + [(i, f"w{i} " * 25) for i in range(2, 802)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    wanted = spark.createDataFrame([("same same",)], "text string")
    found = S.importance_sample(docs, wanted).collect()
    same(found, plain(rows, ["same same"]))
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 301))


def test_query(spark, small, monkeypatch):
    monkeypatch.undo()
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{small}/{t}.parquet").select(*c).collect()]
    expected = plain(read("documents", "doc_id", "text"), [t for (t,) in read("benchmark", "text")])
    same(QUERIES["op12_head_tail_importance"](spark, small).collect(), expected)
