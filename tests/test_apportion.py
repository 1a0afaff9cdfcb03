"""Apportionment: a hand-checked case, properties and a hot area."""

import math

import pytest
from pyspark.sql import functions as F

from peerlens.operators.apportion import apportion, apportion_sums, apportion_wide, roll_up_sums, sums_to_means
from peerlens.operators.joins import BROADCAST_BYTES

WEIGHTS = [("A", "g1", 10), ("A", "g2", 30), ("B", "g2", 5), ("B", "g3", 5), ("C", "g3", 7), ("D", "g9", 1)]
VALUES = [("g1", "m", 2.0), ("g2", "m", 4.0), ("g3", "m", None)]


def frames(spark, weights=WEIGHTS, values=VALUES):
    return (
        spark.createDataFrame(values, "geo_code string, metric string, value double"),
        spark.createDataFrame(weights, "org_code string, geo_code string, weighting long"),
    )


def means(df):
    return {(r.org_code, r.metric): r.value for r in df.collect()}


@pytest.mark.parametrize("names", [None, ["m"]])
def test_hand_checked(spark, names):
    geo, weights = frames(spark)
    assert means(apportion(geo, weights, names)) == {("A", "m"): 3.5, ("B", "m"): 4.0, ("C", "m"): None}


def test_missing_areas_and_scaled_weights_change_nothing(spark):
    geo, weights = frames(spark)
    plain = means(apportion(geo, weights, ["m"]))
    more, _ = frames(spark, values=[*VALUES, ("g8", "m", None)])
    extra = weights.union(spark.createDataFrame([("A", "g8", 1000)], weights.schema))
    assert means(apportion(more, extra, ["m"])) == plain
    assert means(apportion(geo, weights.withColumn("weighting", F.col("weighting") * 8), ["m"])) == plain


def test_many_metrics_span_parts(spark):
    """53 metrics make three parts, the last one padded; each must land in its own column."""
    names = [f"m{i}" for i in range(53)]
    rows = [(f"g{g}", *[None if (g + i) % 5 == 0 else float(g * 100 + i) for i in range(53)]) for g in range(7)]
    geo = spark.createDataFrame(rows, "geo_code string, " + ", ".join(f"{n} double" for n in names))
    links = [(f"o{g % 3}", f"g{g}", g + 1) for g in range(7)] + [("o0", "g1", None)]
    weights = spark.createDataFrame(links, "org_code string, geo_code string, weighting long")
    got = {r.org_code: r.asDict() for r in apportion_wide(geo, weights, names).collect()}
    for org in ("o0", "o1", "o2"):
        for i, n in enumerate(names):
            pairs = [(w, dict(zip(names, r[1:]))[n]) for o, g, w in links if o == org and w for r in rows if r[0] == g]
            known = [(w, v) for w, v in pairs if v is not None]
            want = sum(w * v for w, v in known) / sum(w for w, _ in known) if known else None
            assert (got[org][n] is None) if want is None else math.isclose(got[org][n], want, rel_tol=1e-12)


def test_rolled_up_sums_equal_a_direct_join(spark):
    geo = spark.createDataFrame([("g1", 2.0, 1.0), ("g2", 4.0, None)], "geo_code string, x double, y double")
    weights = spark.createDataFrame(
        [("p1", "u1", "g1", 3), ("p2", "u1", "g2", 5), ("p3", "u2", "g1", 7)],
        "prac string, pcn string, geo_code string, weighting long",
    )
    sums = apportion_sums(geo, weights, ["x", "y"], by=["prac", "pcn"])
    rolled = sums_to_means(roll_up_sums(sums, ["pcn"]), ["pcn"], ["x", "y"])
    direct = apportion_wide(geo, weights.withColumnRenamed("pcn", "org_code"), ["x", "y"])
    assert {tuple(r) for r in rolled.collect()} == {tuple(r) for r in direct.collect()}


@pytest.mark.parametrize("limit", [0, BROADCAST_BYTES])
def test_one_area_holding_a_third_of_the_weights(spark, limit):
    """A hot area and a hot organisation give the same answer as the plain formula."""
    weights = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("o"), F.col("id") % 50)).alias("org_code"),
        F.when(F.col("id") % 3 == 1, "ghot").otherwise(F.concat(F.lit("g"), F.col("id") % 400)).alias("geo_code"),
        (F.col("id") % 17).alias("weighting"),
    )
    geo = spark.range(400).select(F.concat(F.lit("g"), F.col("id")).alias("geo_code"), F.sqrt("id").alias("m"))
    geo = geo.union(spark.createDataFrame([("ghot", 3.25)], "geo_code string, m double"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sums = apportion_sums(geo, weights, ["m"], broadcast_bytes=limit)
        plan = sums._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" in plan and ("SortMergeJoin" in plan) == (limit == 0)  # the hot area is broadcast
        got = {r.org_code: r.m for r in sums_to_means(sums, ["org_code"], ["m"]).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    values = {r.geo_code: r.m for r in geo.collect()}
    top, bottom = {}, {}
    for r in weights.collect():
        top[r.org_code] = top.get(r.org_code, 0.0) + r.weighting * values[r.geo_code]
        bottom[r.org_code] = bottom.get(r.org_code, 0) + r.weighting
    assert got.keys() == {o for o in top}
    assert all(math.isclose(got[o], top[o] / bottom[o], rel_tol=1e-9) for o in got)
