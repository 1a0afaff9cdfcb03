"""Hand-checked cases for the missing-value rules."""

import pytest
from pyspark.sql import functions as F

from peerlens.functions.missing import (
    lenient_int,
    not_in_keeping_null,
    ratio,
    rowwise_sum,
    sum_ignoring,
    sum_poisoning,
)
from peerlens.functions.text import shown, thousands
from peerlens.operators.joins import FeatureNameClash, guarded_feature_join, left_lookup
from peerlens.operators.reshape import long_to_wide, long_to_wide_many, wide_to_long
from peerlens.operators.rollup import removal_report, weighted_quantiles
from peerlens.operators.standardise import standardise


def test_not_in_keeps_missing(spark):
    df = spark.createDataFrame([(None,), ("a",), ("REGISTER",)], "m string")
    assert {r.m for r in df.filter(not_in_keeping_null("m", ["REGISTER"])).collect()} == {None, "a"}


def test_missing_keys_meet_when_asked(spark):
    left = spark.createDataFrame([("p", 1), (None, 2)], "k string, a int")
    right = spark.createDataFrame([("p", 10), (None, 20)], "j string, b int")
    safe = {(r.k, r.a, r.b) for r in left_lookup(left, right, [("k", "j")], null_safe=True).collect()}
    plain = {(r.k, r.a, r.b) for r in left_lookup(left, right, [("k", "j")]).collect()}
    assert safe == {("p", 1, 10), (None, 2, 20)}
    assert plain == {("p", 1, 10), (None, 2, None)}


def test_sums_ignore_or_poison(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("c", None)], "g string, v double")
    rows = df.groupBy("g").agg(sum_ignoring("v").alias("i"), sum_poisoning("v").alias("p")).collect()
    assert {r.g: (r.i, r.p) for r in rows} == {"a": (1.0, None), "b": (2.0, 2.0), "c": (0.0, None)}


def test_division_and_parsing(spark):
    row = spark.range(1).select(
        ratio(F.lit(0), F.lit(0)).alias("zero"),
        ratio(F.lit(5), F.lit(0)).alias("inf"),
        lenient_int(F.lit("95+"), 95).alias("band"),
        lenient_int(F.lit(" 4"), 95).alias("space"),
        lenient_int(F.lit(""), 95).alias("blank"),
        lenient_int(F.lit("3.7"), 95).alias("cut"),
        rowwise_sum([F.lit(1.5), F.lit(None).cast("double"), F.lit(2)]).alias("across"),
        thousands(F.lit(12345)).alias("thousands"),
        shown(F.lit(None).cast("string")).alias("missing"),
    ).first()
    assert (row.zero, row.inf) == (None, None)
    assert (row.band, row.space, row.blank, row.cut) == (95, 4, 95, 3)
    assert (row.across, row.thousands, row.missing) == (3.5, "12,345", "NA")


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, 3), (2, 0), (5, 4), (9, 1), (10, 2)], [2.0, 5.0, 8.0]),
        ([(1, 0), (7, 0)], [None, None, None]),
        ([(1, None), (7, 2)], [7.0, 7.0, 7.0]),
    ],
)
def test_weighted_quartiles(spark, rows, want):
    df = spark.createDataFrame([("g", *r) for r in rows], "g string, age int, popn long")
    out = weighted_quantiles(df, ["g"], "age", ["popn"], {"q1": 0.25, "median": 0.5, "q3": 0.75}, total="n")
    row = out.first()
    assert [row.q1_popn, row.median_popn, row.q3_popn] == want


def test_pivot_fills_only_absent_combinations(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", None), ("b", "x", 2.0)], "g string, n string, v double")
    filled = {r.g: (r.x, r.y) for r in long_to_wide(df, ["g"], "n", "v", ["x", "y"], absent=0.0).collect()}
    bare = {r.g: (r.first, r.y) for r in long_to_wide(df, ["g"], "n", "v", {"x": "first", "y": "y"}).collect()}
    assert filled == {"a": (1.0, None), "b": (2.0, 0.0)}
    assert bare == {"a": (1.0, None), "b": (2.0, None)}


def test_pivot_of_several_values(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 3.0), ("a", "y", 2.0, 4.0)], "g string, n string, v double, w double")
    out = long_to_wide_many(df, ["g"], "n", ["v", "w"], ["x", "y"], "{name}_{value}")
    assert out.columns == ["g", "x_v", "y_v", "x_w", "y_w"]
    assert tuple(out.first()) == ("a", 1.0, 2.0, 3.0, 4.0)


def test_duplicate_cells_fail(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 1.0)], "g string, n string, v double")
    for absent in (None, 0.0):
        with pytest.raises(Exception, match="duplicate key"):
            long_to_wide(df, ["g"], "n", "v", ["x"], absent=absent).collect()


def test_unpivot_keeps_missing(spark):
    df = spark.createDataFrame([("a", 1, None)], "g string, x int, y double")
    assert {(r.metric, r.value) for r in wide_to_long(df, ["g"]).collect()} == {("x", 1.0), ("y", None)}


def test_standardise(spark):
    df = spark.createDataFrame([(1, 1.0, 0.1), (2, None, 0.1), (3, 3.0, 0.1)], "k int, x double, c double")
    rows = {r.k: (r.x, r.c) for r in standardise(df, ["k"], ["x", "c"]).collect()}
    assert rows[1][0] == pytest.approx(-0.7071067811865475)
    assert rows[2][0] is None and rows[3][0] == pytest.approx(0.7071067811865475)
    assert all(c is None for _, c in rows.values())
    zeroed = {r.k: (r.x, r.c) for r in standardise(df, ["k"], ["x", "c"], missing_as_zero=True).collect()}
    assert sum(x for x, _ in zeroed.values()) == pytest.approx(0.0)
    assert all(c == 0.0 for _, c in zeroed.values())
    single = standardise(df.filter("k = 1"), ["k"], ["x"]).first()
    assert single.x is None


def test_name_guard_ignores_case(spark):
    index = spark.createDataFrame([("a", 1)], "org_code string, Size int")
    with pytest.raises(FeatureNameClash, match="size"):
        guarded_feature_join(index, spark.createDataFrame([("a", 2)], "org_code string, size int"), "org_code")
    ok = guarded_feature_join(index, spark.createDataFrame([("a", 2)], "k string, other int"), "org_code", "k")
    assert tuple(ok.first()) == ("a", 1, 2)


def test_removal_report(spark):
    df = spark.createDataFrame([("E1",), ("W1",), ("E2",)], "a string")
    assert removal_report(df, F.col("a").startswith("E")).first().report == "Rows removed: 1 (33.33%)"
