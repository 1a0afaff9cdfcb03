"""Neighbour lists brought up to date after rows came, went or changed.

A list changes only if its owner changed, if it lost a member, or if a new or
changed row comes near (or far) enough.  So three things are done, and the
result is that of a full rebuild:

* owners that are new or changed get new lists, from all rows;
* lists that lost a member, found through the reverse index (who lists whom),
  are filled again, from all rows;
* every other list is merged with the distances to the new and changed rows only.

Distances are of vectors as they are: a new scaling of all features changes
every row, and then a full rebuild is the right job.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.operators.balls import best_k, lists_in_ball
from peerlens.operators.blocks import MAX_BLOCK_ROWS, MIN_BLOCK_ROWS
from peerlens.sources.staging import stage


@dataclass
class Refreshed:
    """The lists, how many were made anew, and how many directed pairs were compared."""

    lists: DataFrame
    redone: int
    compared: int


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(key, gone, come)``: keys whose row is not as it was; an update is both."""
    before = old.select("key", F.col("vec").alias("before"), F.lit(True).alias("had"))
    after = new.select("key", F.col("vec").alias("after"), F.lit(True).alias("has"))
    both = before.join(after, "key", "full_outer").where("had IS NULL OR has IS NULL OR NOT before <=> after")
    return both.select("key", F.col("had").isNotNull().alias("gone"), F.col("has").isNotNull().alias("come"))


def reverse_index(lists: DataFrame) -> DataFrame:
    """``(dest, list, orig)`` in order of ``dest``, so that a few members are found without reading all."""
    return lists.select("dest", "list", "orig").repartitionByRange("dest").sortWithinPartitions("dest")


def lists_against(guests: DataFrame, hosts: DataFrame, k: int, wanted: Sequence[str], max_rows: int = MAX_BLOCK_ROWS) -> DataFrame:
    """The k best of ``hosts(key, vec)`` for each of ``guests(key, vec, nearest, farthest)``, for the lists it asks for.

    Both sides are hashed into parts of bounded size and each pair of parts is
    one group.  Both are stored tables.
    """
    spark = guests.sparkSession
    kind = hosts.schema["key"].dataType.simpleString()
    schema = f"list string, orig {kind}, dest {kind}, distance double, rank_distance double"
    cores = spark.sparkContext.defaultParallelism

    def parts(df: DataFrame) -> int:
        rows = df.count()
        return max(1, math.ceil(rows / max_rows), min(rows // MIN_BLOCK_ROWS, math.ceil(math.sqrt(cores))))

    n_guests, n_hosts = parts(guests), parts(hosts)

    def dealt(df: DataFrame, own: int, other: int, place) -> DataFrame:
        part = F.pmod(F.xxhash64("key"), F.lit(own)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        return df.withColumn("part", part).withColumn("other", each).withColumn("group", place).drop("part", "other")

    left = dealt(guests, n_guests, n_hosts, F.col("part") * n_hosts + F.col("other"))
    right = dealt(hosts.select("key", "vec"), n_hosts, n_guests, F.col("other") * n_hosts + F.col("part"))
    as_arrow = spark.createDataFrame([], schema).toArrow().schema
    found = left.groupBy("group").cogroup(right.groupBy("group")).applyInArrow(lists_in_ball(k, wanted, as_arrow), schema)
    return best_k(found, k)


def updated_lists(
    old: DataFrame,
    new: DataFrame,
    lists: DataFrame,
    k: int,
    wanted: Sequence[str] = ("nearest", "farthest"),
    max_rows: int = MAX_BLOCK_ROWS,
    reverse: DataFrame | None = None,
) -> Refreshed:
    """``lists(list, orig, dest, distance, rank_distance)`` of ``old(key, vec)`` made those of ``new(key, vec)``.

    ``new`` and ``lists`` are stored tables, ``reverse`` the stored reverse index
    if there is one.
    """
    changed = stage(changes(old, new), "changes")
    gone, come = (changed.where(c).select("key") for c in ("gone", "come"))
    members = reverse_index(lists) if reverse is None else reverse
    lost = members.join(gone, F.col("dest") == F.col("key"), "left_semi").select("list", F.col("orig").alias("key")).distinct()
    lost = stage(lost.join(gone, "key", "left_anti"), "lost")

    asked = lost.groupBy("key").agg(*(F.max(F.col("list") == w).alias(w) for w in ("nearest", "farthest")))
    whole = come.select("key", *(F.lit(w in wanted).alias(w) for w in ("nearest", "farthest")))
    redo = stage(new.select("key", "vec").join(asked.unionByName(whole), "key"), "redo")
    arrived = stage(new.select("key", "vec").join(come, "key", "left_semi"), "arrived")
    # Of the rows that stay as they are, the lists that are not made anew.
    stay = new.select("key", "vec").join(come, "key", "left_anti").join(asked, "key", "left")
    keeps = {w: F.lit(w in wanted) & ~F.coalesce(w, F.lit(False)) for w in ("nearest", "farthest")}
    stay = stage(stay.withColumns(keeps).where("nearest OR farthest"), "stay")

    whole_lists = lists.select("list", "orig", "dest", "distance", "rank_distance")
    kept = whole_lists.join(gone.withColumnRenamed("key", "orig"), "orig", "left_anti")
    kept = kept.join(lost.withColumnRenamed("key", "orig"), ["list", "orig"], "left_anti")
    parts = kept.unionByName(lists_against(redo, new, k, wanted, max_rows)).unionByName(lists_against(stay, arrived, k, wanted, max_rows))
    result = stage(best_k(parts, k), "lists")
    rows = new.count()
    redone = redo.select((F.col("nearest").cast("int") + F.col("farthest").cast("int")).alias("n")).agg(F.sum("n")).first()[0] or 0
    return Refreshed(result, redone, redo.count() * max(rows - 1, 0) + stay.count() * arrived.count())
