"""Quantiles by rank against one state a group, and with groups that no task could hold."""

import random

import pytest
from pyspark.sql import functions as F

from peerlens.operators.quantiles import weighted_quantiles_by_rank
from peerlens.operators.rollup import weighted_quantiles

SHARES = {"least": 0.0, "q1": 0.25, "mid": 0.5, "p99": 0.99, "most": 1.0}
SPREAD = ("range", "most", "least")


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("most", [3, 250_000])
def test_equal_to_percentile(spark, most):
    rng = random.Random(most)
    rows = []
    for i in range(4000):
        value = rng.choice([None, 0.0, -0.0, rng.gauss(0, 1), 10 ** rng.uniform(-200, 200), float(rng.randrange(30)), -1e9])
        key = rng.choice(["hot", "hot", None, "a", f"k{rng.randrange(9)}"])
        rows.append((key, value, rng.choice([0, 1, 7, 10**6, None]), rng.randrange(3), "clash"))
    rows += [("no weight", 1.0, 0, 0, "x"), ("no value", None, 5, 5, "x"), ("one", 2.5, 1, 1, "x")]
    df = spark.createDataFrame(rows, "org string, v double, females long, males long, value string").repartition(5)
    want = weighted_quantiles(df, ["org"], "v", ["females", "males"], SHARES, spread=SPREAD)
    got = weighted_quantiles_by_rank(df, ["org"], "v", ["females", "males"], SHARES, spread=SPREAD, most=most)
    assert got.columns == want.columns
    assert found(got) == found(want)


def test_group_of_many_values_and_weight_on_one(spark):
    n = 2_000_000
    values = spark.range(n, numPartitions=16).selectExpr("'hot' AS org", "exp(id / 40000.0) AS v", "1L AS n")
    heavy = spark.range(1).selectExpr("'hot' AS org", "-5.0D AS v", f"{n // 2}L AS n")
    got = weighted_quantiles_by_rank(values.unionByName(heavy), ["org"], "v", ["n"], {"third": 0.3, "upper": 0.75}, most=5000)
    row = got.first()
    assert row.third_n == -5.0 and row.popn_n == n + n // 2
    at = (n + n // 2 - 1) * 0.75 - n // 2  # a position among the single values
    below = values.selectExpr("v").where(F.col("v") < row.upper_n).count()
    assert abs(below - at) <= 1


def test_no_groups_no_rows_and_negative_weights(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 3), (float("nan"), 9)], "v double, n long")
    assert [tuple(r) for r in weighted_quantiles_by_rank(df, [], "v", ["n"], {"m": 0.5}).collect()] == [(2.0, 13)]
    grouped = df.withColumn("g", F.lit("x"))
    assert weighted_quantiles_by_rank(grouped.limit(0), ["g"], "v", ["n"], {"m": 0.5}).collect() == []
    with pytest.raises(Exception, match="negative frequency"):
        weighted_quantiles_by_rank(grouped.withColumn("n", F.lit(-1)), ["g"], "v", ["n"], {"m": 0.5}).collect()
