"""Mixing sources to target weights by Efraimidis-Spirakis sampling, on built-in functions only.

Every source gets a target of words.  A target above one pass over the source
takes complete passes first (epochs); the rest is drawn without replacement:
each document has the exponential key ``-ln(u) / quality`` with ``u`` from a hash
of its id, and documents are taken whole by rising key until their summed
sizes are nearest to what is missing.

Summing by key needs no sorted source: sizes are added up by source and key
bin, bins are summed up along the key, and only the one bin of each source in
which the budget ends is put in order.  The bins follow the distribution of the
keys, so that bin holds about ``1 / BINS`` of its source; it is exact however
the rows lie.

Sizes are words; null and empty texts have size 0 and take nothing.  Rows that
repeat are documents of their own, and equal keys are ordered by id, text hash
and size, so reruns agree.  A null source is a source of its own, the last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm.store import stored

BINS = 4096
# Characters of markup and tables; their share lowers a document's quality weight.
SYMBOLS = "*#$%&!|{}<>=@~^_"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str) -> Column:
    """Between 1/11 and 1: the fewer symbols, the more."""
    length = F.length(text)
    symbols = length - F.length(F.translate(text, SYMBOLS, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.coalesce(F.try_divide(F.lit(10.0) * symbols, length), F.lit(0.0)))


def exponential_key(doc_id: str, weight: Column) -> Column:
    """``-ln(u) / weight``, ``u`` in (0, 1) from the first 52 bits of the id's md5."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def _marked(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as one struct, with what the draw needs."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    keyed = rows.select(
        "row",
        "doc_id",
        "source",
        word_count("text").alias("size"),
        F.xxhash64("text").alias("digest"),
        exponential_key("doc_id", quality_weight("text")).alias("key"),
    )
    return keyed.withColumn("bin", F.floor((1 - F.exp(-F.col("key"))) * BINS))


def targets(
    sizes: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes(source, source_size)``.

    Sources by code point, null last, weigh ``weights``, repeating.  Together
    they get ``share`` of all sizes; no target exceeds ``most`` times its source,
    and the excess is shared by weight among the others until none is above.
    That is one level for all sources: sorted by where they fill up, the level is
    that of the first source which the rest, shared from it on, does not fill.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    listed = (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(most))
        .withColumn("full_at", F.col("most") / F.col("weight"))
    )
    rising = Window.orderBy("full_at", "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(onward)
    leveled = listed.withColumn("level", level).withColumn(
        "open", F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "place", "level"))
    )
    shared = F.min("open").over(whole).getField("level")
    return leveled.select(
        "source",
        "source_size",
        F.least("most", F.coalesce(F.col("weight") * shared, F.col("most"))).alias("target"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """``(row, doc_id, size, source_size, target, copies, taken)`` for each row of ``docs``.

    ``docs`` has ``doc_id``, ``source`` and ``text``; ``row`` holds all its columns.
    ``copies`` is how often the mix takes the document, ``taken`` its words.
    """
    marked = _marked(docs)
    bins = stored(marked.groupBy("source", "bin").agg(F.sum("size").alias("size")), "mix-bins")
    sources = targets(bins.groupBy("source").agg(F.sum("size").alias("source_size")), **options)
    sources = sources.withColumn(
        "epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    along = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = (
        bins.withColumn("to", F.sum("size").over(along))
        .join(sources.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
        .where("to > rest")
        .groupBy("source")
        .agg(F.min(F.struct("bin", (F.col("to") - F.col("size")).alias("before"))).alias("end"))
        .select(F.col("source").alias("e"), "end.bin", "end.before")
        .withColumnsRenamed({"bin": "end_bin"})
    )
    plan = stored(
        sources.join(ended, F.col("source").eqNullSafe(F.col("e")), "left")
        .withColumnRenamed("source", "s")
        .drop("e"),
        "mix-plan",
    )
    placed = marked.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # A source whose rest reaches past its last bin has no end bin: all its documents are taken.
    clear = placed.where("end_bin IS NULL OR bin <> end_bin").withColumn(
        "extra", F.expr("IF(rest > 0 AND (end_bin IS NULL OR bin < end_bin), 1L, 0L)")
    )
    order = Window.partitionBy("source").orderBy("key", "doc_id", "digest", "size")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    mixed = (
        placed.where("bin = end_bin")
        .withColumn("from", F.col("before") + upto - F.col("size"))
        .withColumn("extra", F.expr("IF(rest > 0 AND 2 * from + size <= 2 * rest, 1L, 0L)"))
    )
    names = ["row", "doc_id", "size", "source_size", "target", "epochs", "extra"]
    return (
        clear.select(names)
        .unionByName(mixed.select(names))
        .withColumn("copies", F.col("epochs") + F.col("extra"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("epochs", "extra")
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken; rows without words go."""
    taken = mix(docs, **options).where("taken > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
