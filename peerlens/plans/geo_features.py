"""Features that come per small area and are apportioned to organisations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.functions.columns import over_columns
from peerlens.functions.missing import ratio, sum_poisoning
from peerlens.operators.apportion import apportion_sums, roll_up_sums, sums_to_means
from peerlens.operators.joins import chain_left, left_lookup, unique_by
from peerlens.operators.rollup import grouped_sums
from peerlens.plans.names import DEPRIVATION, ETHNIC_GROUPS, ZERO_WHEN_MISSING, geo_features
from peerlens.plans.organisations import is_english


def density_by_area(registrations: DataFrame, areas: DataFrame) -> DataFrame:
    """Registered people per square kilometre; one row per registered area."""
    people = registrations.groupBy("lsoa11cd").agg(sum_poisoning("reg_popn").alias("total_popn"))
    sizes = areas.filter(is_english("LSOA11CD")).select("LSOA11CD", (F.col("Shape__Are") / 1e6).alias("area_km2"))
    joined = left_lookup(people, unique_by(sizes, "LSOA11CD", "areas"), [("lsoa11cd", "LSOA11CD")])
    return joined.select(F.col("lsoa11cd").alias("geo_code"), ratio("total_popn", "area_km2").alias("popn_per_km2"))


def ethnicity_by_area(area_map: DataFrame, ethnicity: DataFrame) -> DataFrame:
    """Shares per group on the older areas; complex area changes are left out."""
    mapped = area_map.filter(F.col("chgind") != "X").select("lsoa11cd", "lsoa21cd")
    counts = [*ETHNIC_GROUPS, "total_popn"]
    groups = unique_by(ethnicity.select("lsoa21cd", *counts), "lsoa21cd", "ethnicity")
    joined = left_lookup(mapped, groups, [("lsoa21cd", "lsoa21cd")])
    summed = grouped_sums(joined, ["lsoa11cd"], counts, missing="poison")
    return summed.select(
        F.col("lsoa11cd").alias("geo_code"), *over_columns(ETHNIC_GROUPS, lambda c: ratio(c, "total_popn"))
    )


def zero_filled(indicators: DataFrame) -> DataFrame:
    """Missing counts of an indicator table as 0, for the columns where that is the rule."""
    filled = [c for c in indicators.columns if c in ZERO_WHEN_MISSING]
    return indicators.fillna(0, subset=filled) if filled else indicators


def deprivation_by_area(scores: DataFrame, indicators: Mapping[str, DataFrame]) -> DataFrame:
    """Scores and underlying indicators side by side, one row per scored area."""
    tables = [unique_by(zero_filled(t), "lsoa11cd", f"indicators_{name}") for name, t in indicators.items()]
    wide = chain_left(unique_by(scores, "lsoa11cd", "scores"), tables, "lsoa11cd")
    return wide.withColumnRenamed("lsoa11cd", "geo_code")


def area_features(density: DataFrame, ethnicity: DataFrame, deprivation: DataFrame) -> DataFrame:
    """All area measures in one table, so that the weights are joined to it once.

    The density table has every area that carries a weight, so left joins from
    it lose nothing.
    """
    return chain_left(
        density, [ethnicity, deprivation.select("geo_code", *[F.col(c).cast("double") for c in DEPRIVATION])], "geo_code"
    )


def organisation_sums(
    registrations: DataFrame, areas: DataFrame, metrics: Sequence[str] | None = None
) -> DataFrame:
    """Apportionment sums per (practice, practice group): one join for both levels."""
    metrics = geo_features() if metrics is None else metrics
    weights = registrations.select(
        "prac_code", "pcn_code", F.col("lsoa11cd").alias("geo_code"), F.col("reg_popn").alias("weighting")
    )
    return apportion_sums(areas, weights, metrics, by=["prac_code", "pcn_code"])


def level_means(sums: DataFrame, level: str, metrics: Sequence[str] | None = None) -> DataFrame:
    """Weighted means of one level from the shared sums, keyed by ``org_code``."""
    metrics = geo_features() if metrics is None else metrics
    rolled = roll_up_sums(sums, [level]).withColumnRenamed(level, "org_code")
    return sums_to_means(rolled, ["org_code"], metrics)
