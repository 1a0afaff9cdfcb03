"""Tables written once in the shared folder, and connected components on them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlens.sources.staging import new_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_end_with_the_job(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go when it is done: its result is stored, nobody reads them again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read again.

    Lineage ends here: a lost executor repeats only what follows.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    with _shuffles_end_with_the_job(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SPARKS_OWN = 64 << 20


def small_batches(spark: SparkSession, limit: int = 8 << 20) -> None:
    """Whole texts go to Python by ``limit`` bytes at a time, unless the session sets a limit itself.

    Spark's own limit holds several times its bytes in the JVM and in each worker.
    """
    if spark.conf.get(BATCH_BYTES).rstrip("b") == str(SPARKS_OWN):
        spark.conf.set(BATCH_BYTES, str(limit))


def discard(df: DataFrame) -> None:
    """Remove the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)``: the smallest node each node is connected with.

    ``edges`` has long columns ``a`` and ``b``.  Alternating large-star and
    small-star rounds; each ends in a stored table and only its row count and
    checksum reach the driver.  Minima combine on the map side, and the joins
    of a hot node may be split by adaptive execution.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(least, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b"))
            )
        return out.where("a <> b").distinct()

    def mark(pairs: DataFrame) -> tuple:
        h = F.xxhash64("a", "b")
        row = pairs.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first()
        return tuple(row)

    flat = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = stored(flat, "edges")
    before = mark(now)
    for _ in range(max_rounds):
        if not before[0]:
            break
        after = stored(star(star(now, True), False), "edges")
        seen = mark(after)
        discard(now)
        now, done = after, seen == before
        before = seen
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
