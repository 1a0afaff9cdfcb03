"""Features that come per organisation: age, conditions, achievement, staff, income."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.functions.columns import rename_all
from peerlens.functions.missing import lenient_int, not_in_keeping_null, ratio, rowwise_sum, sum_ignoring
from peerlens.operators.joins import left_lookup, unique_by
from peerlens.operators.reshape import long_to_wide, long_to_wide_many
from peerlens.operators.rollup import grouped_sums, ratio_rollup, weighted_quantiles
from peerlens.plans.names import GENDERS, OPEN_AGE_BAND, PARENT_STAFF, PRACTICE_STAFF, QUARTILES


def with_parent(df: DataFrame, members: DataFrame, key: str = "prac_code") -> DataFrame:
    """Attach the practice group; a practice in two groups fails the job."""
    return left_lookup(df, unique_by(members.select("prac_code", "pcn_code"), "prac_code", "members"), [(key, "prac_code")])


def age_table(females: DataFrame, males: DataFrame) -> DataFrame:
    """The two single-gender tables under one another, tagged."""
    return females.withColumn("gender", F.lit("females")).unionByName(males.withColumn("gender", F.lit("males")))


def age_quartiles(ages: DataFrame, level: str, members: DataFrame | None = None) -> DataFrame:
    """Age quartiles, their spread and the population, per gender.

    The all-ages rows are dropped before the reshape.  All three frequency
    columns are answered by one aggregate, so nothing is expanded or pivoted
    back.
    """
    single_years = ages.filter(F.col("age") != "ALL")
    cells = long_to_wide(single_years, ["prac_code", "age"], "gender", "popn", ["females", "males"])
    cells = cells.withColumns(
        {"persons": F.col("females") + F.col("males"), "age": lenient_int("age", OPEN_AGE_BAND)}
    )
    if members is not None:
        cells = with_parent(cells, members)
    summed = grouped_sums(cells, [level, "age"], GENDERS, missing="poison")
    return weighted_quantiles(summed, [level], "age", GENDERS, QUARTILES, spread=("iqr", "q3", "q1"))


def prevalence_practice(prevalence: DataFrame, conditions: Sequence[str]) -> DataFrame:
    """Share of the list on each condition register, one column per condition."""
    rates = prevalence.select(
        "PRACTICE_CODE",
        F.lower("GROUP_CODE").alias("GROUP_CODE"),
        ratio("REGISTER", "PRACTICE_LIST_SIZE").alias("PREV"),
    )
    return long_to_wide(rates, ["PRACTICE_CODE"], "GROUP_CODE", "PREV", conditions)


def prevalence_parent(prevalence: DataFrame, members: DataFrame, conditions: Sequence[str]) -> DataFrame:
    """The same per practice group: ratio of the summed registers and lists."""
    lowered = prevalence.withColumn("GROUP_CODE", F.lower("GROUP_CODE"))
    joined = with_parent(lowered, members, "PRACTICE_CODE")
    rates = ratio_rollup(joined, ["pcn_code", "GROUP_CODE"], "REGISTER", "PRACTICE_LIST_SIZE", "PREV")
    return long_to_wide(rates, ["pcn_code"], "GROUP_CODE", "PREV", conditions)


def achievement(
    rows: DataFrame, level: str, indicators: Sequence[str], members: DataFrame | None = None
) -> DataFrame:
    """Achievement per indicator, with and without the excepted patients.

    The measures are summed straight from the long rows with conditional sums:
    one shuffle on (organisation, indicator), combined on the map side.
    """
    kept = rows.filter(not_in_keeping_null("MEASURE", ["ACHIEVED_POINTS", "REGISTER"]))
    if members is not None:
        kept = with_parent(kept, members, "PRACTICE_CODE")
    measures = ["NUMERATOR", "DENOMINATOR", "PCAS"]
    sums = kept.groupBy(level, "INDICATOR_CODE").agg(
        *[sum_ignoring(F.when(F.col("MEASURE") == m, F.col("VALUE"))).alias(m) for m in measures]
    )
    rates = sums.select(
        level,
        "INDICATOR_CODE",
        ratio("NUMERATOR", "DENOMINATOR").alias("ACHV"),
        ratio(F.col("NUMERATOR"), F.col("DENOMINATOR") + F.col("PCAS")).alias("ACHV_RAW"),
    )
    wide = long_to_wide_many(
        rates, [level], "INDICATOR_CODE", ["ACHV", "ACHV_RAW"], indicators, template="{name}{value}"
    )
    return rename_all(wide, lambda c: c.replace("ACHV", "").lower())


def workforce_practice(staff: DataFrame, groups: Mapping[str, str] = PRACTICE_STAFF) -> DataFrame:
    """Full-time equivalents per staff group; a group that is not listed has 0."""
    totals = staff.filter((F.col("detailed_staff_role") == "Total") & (F.col("measure") == "FTE"))
    return long_to_wide(totals, ["prac_code"], "staff_group", "fte", groups, absent=0.0)


def workforce_parent(staff: DataFrame, groups: Mapping[str, str] = PARENT_STAFF) -> DataFrame:
    """Full-time equivalents per staff group, summed over individual records."""
    summed = grouped_sums(staff, ["pcn_code", "staff_group"], ["fte"])
    return long_to_wide(summed, ["pcn_code"], "staff_group", "fte", groups, absent=0.0)


def income_parent(payments: DataFrame, payment_columns: Sequence[str]) -> DataFrame:
    """All payments of a practice group per registered patient."""
    return payments.select(
        "pcn_code", ratio(rowwise_sum(payment_columns), "reg_popn").alias("income_per_head_popn")
    )
