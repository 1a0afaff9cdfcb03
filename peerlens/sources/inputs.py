"""The input files of the index job: where each column sits and what it becomes.

Files are addressed by a plain mapping of source name to path; ``achievement``
takes a list of extracts.  A source that comes as a worksheet is addressed by a
``Sheet`` (workbook and sheet name), the boundary layer by its ``.dbf`` file;
delimited files with the same columns do as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlens.functions.columns import names_containing, quoted
from peerlens.plans.index import Sources
from peerlens.plans.names import INDICATORS, SCORES
from peerlens.plans.org_features import age_table
from peerlens.plans.organisations import open_only
from peerlens.sources.attributes import read_attributes
from peerlens.sources.readers import read_csv, read_csv_all, read_csv_parts
from peerlens.sources.workbooks import Sheet, read_sheet

Place = str | Sheet

# Fixed values: (1-based position, working name, type) of the columns in use.
FIELDS: dict[str, list[tuple[int, str, str]]] = {
    "registrations": [(3, "prac_code", "string"), (5, "lsoa11cd", "string"), (7, "reg_popn", "bigint")],
    "practices": [
        (1, "prac_code", "string"), (2, "prac_name", "string"), (3, "nhser_code", "string"), (4, "icb_code", "string"),
        (10, "postcode", "string"), (12, "close_date", "string"), (13, "status_code", "string"), (26, "presc_code", "int"),
    ],
    "parents": [
        (1, "pcn_code", "string"), (2, "pcn_name", "string"), (3, "loc_code", "string"), (6, "close_date", "string"),
        (12, "postcode", "string"),
    ],
    "members": [(1, "prac_code", "string"), (5, "pcn_code", "string"), (10, "close_date", "string")],
    "locations": [
        (2, "loc22cd", "string"), (4, "icb22ons", "string"), (5, "icb22cd", "string"), (6, "icb22nm", "string"),
        (8, "nhser22cd", "string"), (9, "nhser22nm", "string"),
    ],
    "postcodes": [(3, "postcode", "string"), (43, "latitude", "double"), (44, "longitude", "double")],
    "age_female": [(4, "prac_code", "string"), (7, "age", "string"), (8, "popn", "bigint")],
    "age_male": [(4, "prac_code", "string"), (7, "age", "string"), (8, "popn", "bigint")],
    "prevalence": [
        (1, "PRACTICE_CODE", "string"), (2, "GROUP_CODE", "string"), (3, "REGISTER", "bigint"),
        (5, "PRACTICE_LIST_SIZE", "bigint"),
    ],
    "achievement": [
        (4, "PRACTICE_CODE", "string"), (5, "INDICATOR_CODE", "string"), (6, "MEASURE", "string"), (7, "VALUE", "double"),
    ],
    "practice_income": [(7, "prac_code", "string"), (73, "income_per_head_popn", "double")],
    "parent_income": [(3, "pcn_code", "string"), (5, "reg_popn", "bigint")]
    + [(p, f"payment_{p}", "double") for p in range(7, 14)],
    "practice_staff": [(1, "prac_code", "string"), (3, "staff_group", "string"), (6, "fte", "double")],
    "parent_staff": [(4, "pcn_code", "string"), (12, "staff_group", "string"), (15, "fte", "double")],
    "ethnicity": [
        (3, "lsoa21cd", "string"), (5, "asian", "bigint"), (11, "black", "bigint"), (15, "mixed", "bigint"),
        (20, "white", "bigint"), (26, "other", "bigint"), (4, "total_popn", "bigint"),
    ],
    "area_map": [(1, "lsoa11cd", "string"), (3, "lsoa21cd", "string"), (5, "chgind", "string")],
}

# First position of the measures of each underlying-indicator table.
FIRST_INDICATOR = 5


def distinct_names(df: DataFrame, column: str) -> list[str]:
    """The names a reshape turns into columns; only the names reach the driver."""
    found = df.select(F.col(column)).distinct().filter(F.col(column).isNotNull()).collect()
    return sorted(r[0] for r in found)


def read_fields(spark: SparkSession, place: Place, fields: Sequence[tuple[int, str, str]], header: bool = True) -> DataFrame:
    """Columns by position, of a sheet or of delimited files."""
    read = read_sheet if isinstance(place, Sheet) else read_csv
    return read(spark, place, fields, header=header)


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """Code and size of each area, from the boundary layer's attributes or a delimited file."""
    columns = ["LSOA11CD", "Shape__Are"]
    raw = read_attributes(spark, path, columns) if path.lower().endswith(".dbf") else read_csv_all(spark, path)
    return raw.select(columns[0], F.col(columns[1]).cast("double").alias(columns[1]))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Area code and every column whose name contains ``score``."""
    raw = read_csv_all(spark, path)
    scores = names_containing(raw, "score")
    if len(scores) != len(SCORES):
        raise ValueError(f"expected {len(SCORES)} score columns, found {len(scores)}")
    return raw.select(
        F.col(quoted(raw.columns[0])).alias("lsoa11cd"),
        *[F.col(quoted(c)).cast("double").alias(n) for c, n in zip(scores, SCORES)],
    )


def read_indicators(spark: SparkSession, path: Place, table: str) -> DataFrame:
    """One underlying-indicator table."""
    measures = [(FIRST_INDICATOR + i, name, "double") for i, name in enumerate(INDICATORS[table])]
    return read_fields(spark, path, [(1, "lsoa11cd", "string"), *measures])


def read_practice_staff(spark: SparkSession, path: str) -> DataFrame:
    """Staff rows by position, with the two columns the filter needs by name."""
    raw = read_csv_all(spark, path)
    picked = [F.col(quoted(raw.columns[p - 1])).cast(t).alias(n) for p, n, t in FIELDS["practice_staff"]]
    return raw.select(
        *picked, F.col("DETAILED_STAFF_ROLE").alias("detailed_staff_role"), F.col("MEASURE").alias("measure")
    )


def load_sources(
    spark: SparkSession,
    paths: Mapping[str, Place | Sequence[str]],
    conditions: Sequence[str] | None = None,
    measures: Sequence[str] | None = None,
    **groups: Mapping[str, str],
) -> Sources:
    """All inputs as working tables.

    ``conditions`` and ``measures`` name the columns to come; left out, they
    are looked up in the data first, at the price of one pass over each file.
    """

    def table(name: str, header: bool = True) -> DataFrame:
        return read_fields(spark, paths[name], FIELDS[name], header)

    prevalence = table("prevalence")
    achievement = read_csv_parts(spark, paths["achievement"], FIELDS["achievement"])
    if conditions is None:
        conditions = distinct_names(prevalence.select(F.lower("GROUP_CODE").alias("name")), "name")
    if measures is None:
        measures = distinct_names(achievement, "INDICATOR_CODE")
    return Sources(
        registrations=table("registrations"),
        practices=table("practices", header=False),
        parents=table("parents"),
        members=open_only(table("members")),
        locations=table("locations"),
        postcodes=table("postcodes"),
        areas=read_areas(spark, paths["areas"]),
        ages=age_table(table("age_female"), table("age_male")),
        prevalence=prevalence,
        achievement=achievement,
        practice_income=table("practice_income"),
        parent_income=table("parent_income"),
        practice_staff=read_practice_staff(spark, paths["practice_staff"]),
        parent_staff=table("parent_staff"),
        ethnicity=table("ethnicity"),
        area_map=table("area_map"),
        scores=read_scores(spark, paths["scores"]),
        indicators={t: read_indicators(spark, paths[f"indicators_{t}"], t) for t in INDICATORS},
        conditions=conditions,
        measures=measures,
        payments=[f"payment_{p}" for p in range(7, 14)],
        **groups,
    )


