"""Properties that hold on the stand-in sources whatever their values."""

import math

import pytest
from pyspark.sql import functions as F

from catalogue import queries as q
from catalogue.views import view
from peerlens.operators.standardise import standardise
from peerlens.plans import geo_features as geo
from peerlens.plans import org_features as org
from peerlens.plans import organisations as orgs
from peerlens.plans.names import ETHNIC_GROUPS

SF = "/root/testdata/sf0.01"


def test_shares_sum_to_one(spark):
    shares = geo.ethnicity_by_area(view(spark, SF, "v_map"), view(spark, SF, "v_eth"))
    complete = shares.dropna().select(sum(F.col(g) for g in ETHNIC_GROUPS).alias("s"))
    low, high, n = complete.agg(F.min("s"), F.max("s"), F.count("s")).first()
    assert n > 0 and math.isclose(low, 1.0) and math.isclose(high, 1.0)


def test_standardised_columns_have_mean_zero_and_deviation_one(spark):
    scaled = standardise(view(spark, SF, "v_cust"), ["org_code"], q.CUSTOMER_FEATURES)
    for c in q.CUSTOMER_FEATURES:
        mean, sd = scaled.agg(F.avg(c), F.stddev_samp(c)).first()
        assert abs(mean) < 1e-9 and math.isclose(sd, 1.0)


def test_distances_are_symmetric_and_complete(spark):
    pairs = q.pairwise_distance(spark, SF)
    n = view(spark, SF, "v_feat").count()
    assert pairs.count() == n * (n - 1)
    assert pairs.filter("orig = dest").count() == 0
    other = pairs.select(F.col("orig").alias("dest"), F.col("dest").alias("orig"), F.col("distance").alias("back"))
    assert pairs.join(other, ["orig", "dest"]).filter("distance IS DISTINCT FROM back").count() == 0


def test_nearest_is_never_beyond_farthest(spark):
    lists = q.neighbours_customer(spark, SF)
    reach = lists.groupBy("orig").pivot("list", ["nearest", "farthest"]).agg(F.max("distance"))
    assert reach.filter("nearest > farthest").count() == 0
    assert lists.groupBy("list", "orig").count().filter("count <> 10").count() == 0


def test_a_practice_in_two_groups_is_refused_at_every_use(spark):
    """One rule for ages, rates and weights: the membership is a lookup with one row per practice."""
    ages = spark.createDataFrame([("p1", "10", g, 3) for g in ("females", "males")], "prac_code string, age string, gender string, popn long")
    members = spark.createDataFrame([("p1", "u1"), ("p1", "u2"), (None, "u2"), (None, "u3")], "prac_code string, pcn_code string")
    registrations = spark.createDataFrame([("p1", "E1", 5)], "prac_code string, lsoa11cd string, reg_popn long")
    for used in (org.age_quartiles(ages, "pcn_code", members), orgs.registration_base(registrations, members)):
        with pytest.raises(Exception, match="members: more than one row for p1"):
            used.collect()
    once = members.where("pcn_code <> 'u2' OR prac_code IS NULL")
    assert [tuple(r) for r in orgs.registration_base(registrations, once).collect()] == [("p1", "u1", "E1", 5)]


def test_group_ratio_is_a_ratio_of_sums(spark):
    prevalence = spark.createDataFrame(
        [("p1", "CAN", 1, 10), ("p2", "CAN", 30, 100), ("p3", "CAN", None, 50)],
        "PRACTICE_CODE string, GROUP_CODE string, REGISTER long, PRACTICE_LIST_SIZE long",
    )
    members = spark.createDataFrame([(p, "u") for p in ("p1", "p2", "p3")], "prac_code string, pcn_code string")
    assert org.prevalence_parent(prevalence, members, ["can"]).first().can == pytest.approx(31 / 160)
    rates = {r.PRACTICE_CODE: r.can for r in org.prevalence_practice(prevalence, ["can"]).collect()}
    assert rates == {"p1": 0.1, "p2": 0.3, "p3": None}
