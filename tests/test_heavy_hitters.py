"""The join that takes hot keys apart, against a plain join."""

import pytest
from pyspark.sql import functions as F

from peerlens.operators.apportion import apportion_sums, apportion_wide
from peerlens.operators.joins import heavy_hitter_join, hot_keys


def plain(df):
    return sorted(map(str, df.collect()))


def big_of(spark, rows=6_000):
    """A third of the rows on one area, a tenth on another, some without any."""
    area = F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN 'warm' WHEN id % 97 = 2 THEN NULL ELSE 'a' || id % 700 END")
    return spark.range(rows).select(F.concat(F.lit("o"), F.col("id") % 50).alias("org_code"), area.alias("geo_code"), "id")


def small_of(spark):
    areas = [("hot", 1.0), ("hot", 2.0), ("warm", None), (None, 9.0), *((f"a{i}", float(i)) for i in range(0, 700, 2))]
    return spark.createDataFrame(areas, "geo_code string, value double")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_a_plain_join(spark, how):
    big, small = big_of(spark), small_of(spark)
    got = heavy_hitter_join(big, small, "geo_code", how, share=1 / 64)
    assert got.columns == big.join(small, "geo_code", how).columns
    assert plain(got) == plain(big.join(small, "geo_code", how))


def test_hot_keys_are_few(spark):
    assert {r.geo_code for r in hot_keys(big_of(spark), "geo_code", 1 / 64).collect()} == {"hot", "warm"}
    assert hot_keys(big_of(spark).limit(0), "geo_code").collect() == []


def test_no_rows(spark):
    big, small = big_of(spark), small_of(spark)
    assert heavy_hitter_join(big.limit(0), small, "geo_code").collect() == []
    assert heavy_hitter_join(big, small.limit(0), "geo_code").collect() == []
    assert heavy_hitter_join(big, small.limit(0), "geo_code", "left").count() == 6_000


def test_only_the_joins_that_keep_the_big_side(spark):
    with pytest.raises(ValueError, match="full"):
        heavy_hitter_join(big_of(spark), small_of(spark), "geo_code", "full")


def test_no_task_gets_the_hot_area(spark):
    """Without broadcast or adaptive execution, the tasks of the join are about alike."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big, small = big_of(spark, 60_000).repartition(8), small_of(spark).where("value > 1")
        joined = heavy_hitter_join(big, small, "geo_code", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
        rows = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert rows[-1] <= 3 * rows[len(rows) // 2]
        unsplit = big.join(small.hint("merge"), "geo_code", "left").groupBy(F.spark_partition_id()).count()
        rows = sorted(r["count"] for r in unsplit.collect())
        assert rows[-1] > 3 * rows[len(rows) // 2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_apportioning_areas_that_are_not_broadcast(spark):
    metrics = [f"m{i}" for i in range(40)]
    values = [F.when((F.col("id") + i) % 7 > 0, F.col("id") * (i + 1)).cast("double").alias(m) for i, m in enumerate(metrics)]
    areas = spark.range(700).select(F.concat(F.lit("a"), F.col("id")).alias("geo_code"), *values)
    areas = areas.unionByName(areas.where("geo_code = 'a3'").withColumn("geo_code", F.lit("hot")))
    weights = big_of(spark).withColumn("weighting", (F.col("id") % 11).cast("double")).drop("id")
    whole = apportion_sums(areas, weights, metrics)
    split = apportion_sums(areas, weights, metrics, broadcast_bytes=0)
    assert plain(split) == plain(whole)
    assert apportion_wide(areas, weights, metrics).count() == 50
