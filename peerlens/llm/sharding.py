"""Shards by a hierarchical weighted hash tree, on built-in functions only.

The tree has regions, racks and shards.  A document descends it: at each node
every child draws ``-ln(u) / weight`` with ``u`` from a hash of the id and the
child's name, and the smallest draw wins, so a child gets its weight's share.
A draw depends on nothing else, so if a weight changes (or a child is new),
documents move only into or out of the subtrees whose weights change.  The law
is ``key``: the id and the tree decide.  The standard tree opens a new region
every four shards and a new rack every two; a ninth shard is a region of its
own and takes rows only into itself.

Slots number the rows of a shard without gaps: rows are counted by shard and
hash bucket, the counts are summed up, and only buckets are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm.store import stored

ROWS_PER_BUCKET = 20_000
REGION, RACK = 4, 2


def tree(weights: Sequence[float]) -> dict[str, list[tuple[str, float]]]:
    """Children and weights of each inner node of the standard tree over shards 0, 1, ..."""
    inner: dict[str, dict[str, float]] = {}
    for shard, weight in enumerate(weights):
        path = ["root", f"region{shard // REGION}", f"rack{shard // RACK}", f"shard{shard}"]
        for parent, child in zip(path, path[1:]):
            children = inner.setdefault(parent, {})
            children[child] = children.get(child, 0.0) + float(weight)
    return {node: list(children.items()) for node, children in inner.items()}


def unit_draw(key: Column, name: Column) -> Column:
    """In (0, 1], from a hash of the key and a name."""
    return (F.shiftrightunsigned(F.xxhash64(key, name), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: three weighted draws down the tree."""
    nodes = tree(weights)
    entries = []
    for node, children in nodes.items():
        listed = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(w).alias("weight")) for c, w in children if w > 0])
        entries += [F.lit(node), listed]
    table = F.create_map(*entries)
    at = F.lit("root")
    for _ in range(3):
        drawn = F.transform(
            F.element_at(table, at),
            lambda c: F.struct((-F.log(unit_draw(key, c.getField("name"))) / c.getField("weight")).alias("d"), c.getField("name").alias("name")),
        )
        at = F.array_min(drawn).getField("name")
    return F.substring(at, 6, 20).cast("int")


def document_key(doc_id: str = "doc_id") -> Column:
    """The id as text; rows without an id share one key."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("none"))


def sharded(docs: DataFrame, weights: Sequence[float] = (1.0,) * 8, column: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; nothing is shuffled."""
    return docs.withColumn(column, shard_of(document_key(), weights))


def shard_table(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of each row of ``docs(doc_id, text)``.

    ``size`` is the text's bytes and 1 (null: 1), ``text_crc32`` null for a null
    text, ``grown_shard`` the shard among one more.  Rows of a shard are numbered
    by bucket, id, checksum and size; rows that repeat get slots of their own.
    """
    text = F.col("text").cast("string")
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            shard_of(document_key(), [1.0] * shards).alias("shard"),
            shard_of(document_key(), [1.0] * (shards + 1)).alias("grown_shard"),
        ),
        "shards",
    )
    buckets = max(1, -(-rows.count() // (shards * ROWS_PER_BUCKET)))
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)))
    along = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = (
        bucketed.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("shard", "bucket", (F.sum("rows").over(along) - F.col("rows")).alias("start"))
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        bucketed.withColumn("number", F.row_number().over(inside))
        .join(starts, ["shard", "bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("start") + F.col("number") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )
