"""Names the outputs must carry.  Fixed values, listed in output order."""

# Identifier columns of an index, and what they are called on display.
ID_COLUMNS = [
    "org_code", "org_name", "postcode", "icb_code", "icb_name",
    "nhser_code", "nhser_name", "latitude", "longitude",
]

# Age features: one set per frequency column.
GENDERS = ["females", "males", "persons"]
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
OPEN_AGE_BAND = 95

# Staff-group value to column.  Values are those of the source files.
PRACTICE_STAFF = {
    "Admin/Non-Clinical": "admin_fte",
    "Direct Patient Care": "dpc_fte",
    "GP": "gp_fte",
    "Nurses": "nurse_fte",
}
PARENT_STAFF = {
    "Admin/Non-Clinical": "admin_fte",
    "Direct Patient Care": "dpc_fte",
    "Director": "dir_fte",
    "GP": "gp_fte",
    "Nurses": "nurse_fte",
}

ETHNIC_GROUPS = ["asian", "black", "mixed", "white", "other"]

# Deprivation scores, in the order of the score columns of the source.
SCORES = [
    "imd", "income_domain", "employment_domain", "education_domain",
    "health_domain", "crime_domain", "housing_and_services_domain", "environment_domain",
    "idaci_subdomain", "idaopi_subdomain", "children_edu_subdomain", "adult_edu_subdomain",
    "geographical_barriers_subdomain", "wider_barriers_subdomain", "indoors_subdomain", "outdoors_subdomain",
]

# Underlying indicators per table, and those whose missing values count as zero.
INDICATORS = {
    "income": ["income_numerator", "idaci_numerator", "idopi_numerator"],
    "employment": ["employment_numerator"],
    "education": ["post_16_education_numerator", "entry_to_higher_edu_numerator", "adult_skills_numerator"],
    "health": [
        "year_of_life_lost", "comparative_illness_and_disability", "acute_morbidity", "mood_and_anxiety_disorders",
    ],
    "barriers": [
        "post_office_distance", "primary_school_distance", "general_store_distance", "gp_distance",
        "household_overcrowding", "homelessness_indicator", "owner_occupation_affordability",
        "private_rental_affordability", "housing_affordability",
    ],
    "environment": [
        "poor_quality_housing", "housing_without_central_heating", "traffic_accidents", "nitrogen_dioxide",
        "benzene", "sulphur_dioxide", "particulates", "air_quality",
    ],
}
ZERO_WHEN_MISSING = [
    "income_numerator", "idaci_numerator", "idopi_numerator", "employment_numerator", "entry_to_higher_edu_numerator",
]

DEPRIVATION = SCORES + [name for names in INDICATORS.values() for name in names]


def age_features() -> list[str]:
    """``q1_females`` ... ``popn_persons``."""
    return [f"{v}_{g}" for v in [*QUARTILES, "iqr", "popn"] for g in GENDERS]


def geo_features() -> list[str]:
    """Every feature that is apportioned from areas."""
    return ["popn_per_km2", *ETHNIC_GROUPS, *DEPRIVATION]


def similarity_features(conditions: list[str]) -> list[str]:
    """Features compared between organisations, chosen by name at both levels.

    Achievement and income are left out; the population counts twice, as
    ``POPN`` and as ``popn_persons``.
    """
    return ["POPN", *age_features(), *conditions, *PRACTICE_STAFF.values(), *geo_features()]
