"""The wide index tables, assembled from the organisation and area features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from peerlens.operators.joins import guarded_feature_join
from peerlens.plans import geo_features as geo
from peerlens.plans import org_features as org
from peerlens.plans import organisations as orgs
from peerlens.plans.names import PARENT_STAFF, PRACTICE_STAFF
from peerlens.sources.staging import stage


@dataclass
class Sources:
    """The input tables, renamed to the working column names."""

    registrations: DataFrame
    practices: DataFrame
    parents: DataFrame
    members: DataFrame
    locations: DataFrame
    postcodes: DataFrame
    areas: DataFrame
    ages: DataFrame
    prevalence: DataFrame
    achievement: DataFrame
    practice_income: DataFrame
    parent_income: DataFrame
    practice_staff: DataFrame
    parent_staff: DataFrame
    ethnicity: DataFrame
    area_map: DataFrame
    scores: DataFrame
    indicators: Mapping[str, DataFrame]
    conditions: Sequence[str]
    measures: Sequence[str]
    payments: Sequence[str]
    practice_groups: Mapping[str, str] = field(default_factory=lambda: PRACTICE_STAFF)
    parent_groups: Mapping[str, str] = field(default_factory=lambda: PARENT_STAFF)


def base(s: Sources) -> DataFrame:
    return orgs.registration_base(s.registrations, s.members)


def area_sums(s: Sources, registrations: DataFrame) -> DataFrame:
    """Apportionment sums per (practice, practice group), shared by both levels."""
    areas = geo.area_features(
        geo.density_by_area(registrations, s.areas),
        geo.ethnicity_by_area(s.area_map, s.ethnicity),
        geo.deprivation_by_area(s.scores, s.indicators),
    )
    return geo.organisation_sums(registrations, areas)


def stored_area_sums(s: Sources) -> DataFrame:
    """The sums as a stored table: organisation-sized from here on.

    Densities and weights both come from the registrations, which are read
    twice, pruned and filtered at the scan, rather than copied.
    """
    return stage(area_sums(s, base(s)), "area-sums")


def _assemble(index: DataFrame, features: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    for table, key in features:
        index = guarded_feature_join(index, table, "org_code", key)
    return index


def practice_table(s: Sources, sums: DataFrame) -> DataFrame:
    """One row per practice with every feature.

    Every registered practice has sums, because every registered area has a
    density; so the sums also tell which practices are registered.
    """
    index = orgs.practice_index(s.practices, sums, s.locations, s.postcodes)
    wide = _assemble(
        index,
        [
            (org.age_quartiles(s.ages, "prac_code"), "prac_code"),
            (org.prevalence_practice(s.prevalence, s.conditions), "PRACTICE_CODE"),
            (org.achievement(s.achievement, "PRACTICE_CODE", s.measures), "practice_code"),
            (org.workforce_practice(s.practice_staff, s.practice_groups), "prac_code"),
            (s.practice_income, "prac_code"),
            (geo.level_means(sums, "prac_code"), "org_code"),
        ],
    )
    return orgs.display_index(wide)


def parent_table(s: Sources, sums: DataFrame) -> DataFrame:
    """One row per practice group; directors have no practice counterpart and go."""
    index = orgs.parent_index(s.parents, s.locations, s.postcodes)
    wide = _assemble(
        index,
        [
            (org.age_quartiles(s.ages, "pcn_code", s.members), "pcn_code"),
            (org.prevalence_parent(s.prevalence, s.members, s.conditions), "pcn_code"),
            (org.achievement(s.achievement, "pcn_code", s.measures, s.members), "pcn_code"),
            (org.workforce_parent(s.parent_staff, s.parent_groups), "pcn_code"),
            (org.income_parent(s.parent_income, s.payments), "pcn_code"),
            (geo.level_means(sums, "pcn_code"), "org_code"),
        ],
    )
    return orgs.display_index(wide, drop=("dir_fte",))
