import zlib

from pyspark.sql import functions as F

from peerlens.llm import sharding


def test_edges(edge_docs, no_docs):
    rows = sharding.shard_table(edge_docs).collect()
    texts = sorted((r.doc_id or -1, r.text or "", r.text is None) for r in edge_docs.collect())
    assert len(rows) == len(texts)
    sizes = sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in rows if r.text_crc32 is not None)
    assert sizes == sorted((k, len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t, null in texts if not null)
    assert all(r["size"] == 1 for r in rows if r.text_crc32 is None)
    assert {r.law for r in rows} == {"key"}
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.shard_table(no_docs).collect() == []
    assert sharding.sharded(edge_docs, column="to").columns == [*edge_docs.columns, "to"]


def test_slots_have_no_gaps_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 10)
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.shard_table(docs).collect()
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots))) and 500 < len(slots) < 760
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert 400 < sum(r.grown_shard == 8 for r in rows) < 720
    again = sharding.shard_table(docs.repartition(13)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def shards(spark, weights, n=8000):
    ids = spark.range(n).select(sharding.shard_of(F.col("id").cast("string"), weights).alias("s"))
    return [r.s for r in ids.collect()]


def test_shares_follow_weights(spark):
    weights = [1.0, 2.0, 1.0, 4.0, 0.0, 3.0, 1.0]
    got = shards(spark, weights)
    for shard, weight in enumerate(weights):
        assert abs(got.count(shard) / len(got) - weight / sum(weights)) < 0.02


def test_movement_is_confined_to_subtrees_whose_weights_change(spark):
    before = shards(spark, [1.0] * 8)
    after = shards(spark, [1.0] * 5 + [2.0] + [1.0] * 2)  # shard 5: region 1, rack 2
    moved = [(a, b) for a, b in zip(before, after) if a != b]
    assert moved and all(b in (4, 5, 6, 7) for _, b in moved)  # only into its region
    inside = [(a, b) for a, b in moved if a >= 4]
    assert all(b in (4, 5) for _, b in inside)  # and, from within it, only into its rack
    grown = shards(spark, [1.0] * 9)
    assert all(a == b or b == 8 for a, b in zip(before, grown))
