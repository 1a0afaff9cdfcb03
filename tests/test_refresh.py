"""Lists brought up to date against a full rebuild, and units of tables."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerlens.operators.neighbours import nearest_and_farthest, placed, with_rank
from peerlens.operators.refresh import changes, updated_lists
from peerlens.sources import units
from peerlens.sources.readers import read_snapshot
from peerlens.sources.sinks import write_snapshots
from peerlens.sources.staging import stage


def vectors_of(spark, rows):
    return stage(spark.createDataFrame(sorted(rows.items()), "key long, vec array<double>"), "test")


def as_rows(df):
    return sorted((r.list, r.orig, r.place, r.dest, None if r.distance is None else round(r.distance, 9)) for r in df.collect())


def some(rng, n, p=4):
    return {int(i): [None if rng.random() < 0.1 else float(v) for v in rng.normal(size=p).round(1)] for i in range(n)}


def changed(rng, rows, inserts, deletes, updates):
    out = dict(rows)
    for key in rng.choice(sorted(out), deletes, replace=False):
        del out[int(key)]
    for key in rng.choice(sorted(out), updates, replace=False):
        out[int(key)] = [float(v) for v in rng.normal(size=4).round(1)]
    return out | {1_000 + i: list(out[min(out)]) if i % 3 == 0 else [float(i), None, 0.5, -1.0] for i in range(inserts)}


@pytest.mark.parametrize("seed, inserts, deletes, updates", [(1, 7, 6, 5), (2, 0, 1, 0), (3, 1, 0, 0), (4, 0, 0, 3), (5, 0, 0, 0)])
def test_equals_a_full_rebuild(spark, seed, inserts, deletes, updates):
    rng = np.random.default_rng(seed)
    rows = some(rng, 160)
    after = changed(rng, rows, inserts, deletes, updates)
    old, new = vectors_of(spark, rows), vectors_of(spark, after)
    lists = stage(with_rank(nearest_and_farthest(old, 4)), "lists")
    found = updated_lists(old, new, lists, 4, max_rows=50)
    assert as_rows(placed(found.lists, 4)) == as_rows(nearest_and_farthest(new, 4))
    n, touched = len(after), inserts + deletes + updates
    assert found.compared <= n * (n - 1) and (touched > 0 or found.compared == 0)


def test_work_follows_the_changes(spark):
    rng = np.random.default_rng(9)
    rows = {i: [float(v) for v in rng.normal(size=4)] for i in range(1_500)}
    after = rows | {7: [9.0, 9.0, 9.0, 9.0], 5_000: [0.0, 0.1, 0.2, 0.3]}
    old, new = vectors_of(spark, rows), vectors_of(spark, after)
    found = updated_lists(old, new, stage(with_rank(nearest_and_farthest(old, 5)), "lists"), 5)
    assert as_rows(placed(found.lists, 5)) == as_rows(nearest_and_farthest(new, 5))
    assert found.redone < 60 and found.compared < 0.05 * 1_501 * 1_500


def test_few_rows_grow_and_shrink(spark):
    few = {1: [0.0], 2: [1.0], 3: [None]}
    for before, after in (({}, few), (few, {}), (few, few | {4: [5.0]}), (few, {1: [0.0]}), ({1: [0.0]}, few)):
        old, new = vectors_of(spark, before), vectors_of(spark, after)
        lists = stage(with_rank(nearest_and_farthest(old, 3)), "lists")
        found = updated_lists(old, new, lists, 3)
        assert as_rows(placed(found.lists, 3)) == as_rows(nearest_and_farthest(new, 3))


def test_changes(spark):
    old = vectors_of(spark, {1: [1.0, None], 2: [2.0, 2.0], 3: [3.0, 3.0], 4: [None, None]})
    new = vectors_of(spark, {1: [1.0, None], 2: [2.0, None], 4: [None, None], 5: [5.0, 5.0]})
    assert {tuple(r) for r in changes(old, new).collect()} == {(2, True, True), (3, True, False), (5, False, True)}


def test_a_save_that_dies_leaves_the_old_set_whole(spark, tmp_path):
    folder = f"{tmp_path}/set"
    one, two = spark.range(3), spark.range(5)
    write_snapshots({"a": one, "b": two}, folder)
    broken = spark.range(4).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_snapshots({"a": two, "b": broken}, folder)
    assert [read_snapshot(spark, f"{folder}/{t}").count() for t in "ab"] == [3, 5]
    write_snapshots({"a": two, "b": one}, folder)
    assert [read_snapshot(spark, f"{folder}/{t}").count() for t in "ab"] == [5, 3]


def test_readers_that_have_begun_keep_their_tables(spark, tmp_path):
    folder = f"{tmp_path}/set"
    write_snapshots({"a": spark.range(3), "b": spark.range(5)}, folder)
    begun = read_snapshot(spark, f"{folder}/a")
    write_snapshots({"a": begun.union(begun)}, folder, keep_others=True)
    assert begun.count() == 3
    assert [read_snapshot(spark, f"{folder}/{t}").count() for t in "ab"] == [6, 5]
    for _ in range(3):
        write_snapshots({"a": spark.range(1)}, folder, keep_others=True)
    assert [read_snapshot(spark, f"{folder}/{t}").count() for t in "ab"] == [1, 5]
    assert len([f for f in os.listdir(f"{folder}/manifests") if f.endswith(".json") and not f.startswith(".")]) == 2
    write_snapshots({"a": spark.range(2)}, folder)
    assert set(units.tables_of(spark, folder)) == {"a"}


def test_two_writers_at_a_time(spark, tmp_path):
    folder = f"{tmp_path}/set"
    write_snapshots({"a": spark.range(3)}, folder)
    with pytest.raises(RuntimeError, match="same time"):
        units._switch(spark, folder, 1, {"a": "elsewhere"})
    assert read_snapshot(spark, f"{folder}/a").count() == 3


def test_plain_tables_are_read_as_before(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/plain")
    assert read_snapshot(spark, f"{tmp_path}/plain").count() == 4
    assert units.is_stored(spark, f"{tmp_path}/plain") and not units.is_stored(spark, f"{tmp_path}/none")
