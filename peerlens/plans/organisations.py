"""Registration base and the two organisation indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.operators.joins import left_lookup, registered_only, unique_by
from peerlens.plans.names import ID_COLUMNS


def is_english(area: str):
    """Area codes of England; a prefix test that reaches the Parquet scan."""
    return F.col(area).startswith("E")


def open_only(df: DataFrame) -> DataFrame:
    """Records without a closing date; the date itself is then of no use."""
    return df.filter(F.col("close_date").isNull()).drop("close_date")


def active_practices(practices: DataFrame) -> DataFrame:
    """Open, active practices of the general-practice prescribing setting."""
    kept = F.col("close_date").isNull() & (F.col("status_code") == "A") & (F.col("presc_code") == 4)
    return practices.filter(kept).drop("close_date", "status_code", "presc_code")


def registration_base(registrations: DataFrame, members: DataFrame) -> DataFrame:
    """English registrations with the practice group attached; a practice in two groups fails the job."""
    english = registrations.filter(is_english("lsoa11cd"))
    groups = unique_by(members.select("prac_code", "pcn_code"), "prac_code", "members")
    joined = left_lookup(english, groups, [("prac_code", "prac_code")])
    return joined.select("prac_code", "pcn_code", "lsoa11cd", "reg_popn")


def _with_coordinates(orgs: DataFrame, postcodes: DataFrame) -> DataFrame:
    located = left_lookup(orgs, postcodes, [("postcode", "postcode")])
    return located.select(*ID_COLUMNS)


def practice_index(
    practices: DataFrame, registrations: DataFrame, locations: DataFrame, postcodes: DataFrame
) -> DataFrame:
    """One row per active, registered practice with region names and coordinates."""
    present = registered_only(active_practices(practices), registrations, "prac_code")
    regions = locations.select("icb22cd", "icb22nm", "nhser22cd", "nhser22nm").distinct()
    named = left_lookup(present, regions, [("icb_code", "icb22cd"), ("nhser_code", "nhser22cd")], null_safe=True)
    orgs = named.select(
        F.col("prac_code").alias("org_code"), F.col("prac_name").alias("org_name"), "postcode",
        "icb_code", F.col("icb22nm").alias("icb_name"), "nhser_code", F.col("nhser22nm").alias("nhser_name"),
    )
    return _with_coordinates(orgs, postcodes)


def parent_index(details: DataFrame, locations: DataFrame, postcodes: DataFrame) -> DataFrame:
    """One row per open practice group."""
    named = left_lookup(open_only(details), locations, [("loc_code", "loc22cd")], null_safe=True)
    orgs = named.select(
        F.col("pcn_code").alias("org_code"), F.col("pcn_name").alias("org_name"), "postcode",
        F.col("icb22cd").alias("icb_code"), F.col("icb22nm").alias("icb_name"),
        F.col("nhser22cd").alias("nhser_code"), F.col("nhser22nm").alias("nhser_name"),
    )
    return _with_coordinates(orgs, postcodes)


def display_index(index: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Upper-case identifiers, the population copied in front, some columns dropped."""
    rest = [c for c in index.columns if c not in ID_COLUMNS and c not in drop]
    return index.select(
        *[F.col(c).alias(c.upper()) for c in ID_COLUMNS], F.col("popn_persons").alias("POPN"), *rest
    )
