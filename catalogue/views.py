"""Source tables of the engine, derived from the driver's tables.

The driver's tables hold no organisations, so each source the engine reads is
stated as a view over them.  The text is plain SQL that Spark and DuckDB read
alike.  Missing values, zero denominators, closed records and unknown codes
are planted on purpose; no view leaves rows of its tables out to save work.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from peerlens.plans.names import INDICATORS, SCORES

# Columns of the driver's tables.  Stating them saves a footer-reading job per read.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def _measure(position: int, name: str) -> str:
    """One deprivation measure of an area: a smooth and a rough part, missing for some areas."""
    missing = f"p_size % 11 = {position % 11}"
    value = f"sqrt(p_retailprice * {position}) + CAST((p_partkey * {position}) % {30 + position} AS DOUBLE)"
    return f"CASE WHEN {missing} THEN NULL ELSE {value} END AS {name}"


def _indicator_view(table: str, first: int) -> str:
    measures = ", ".join(_measure(first + i, name) for i, name in enumerate(INDICATORS[table]))
    unknown = f"CASE WHEN p_size = {first} THEN 'X' ELSE 'E' END || CAST(p_partkey AS STRING)"
    return f"SELECT {unknown} AS lsoa11cd, {measures} FROM part"


VIEWS: dict[str, str] = {
    "v_reg": """
        SELECT 'P' || CAST(l_suppkey AS STRING) AS prac_code,
               CASE WHEN l_partkey % 20 = 0 THEN 'W' ELSE 'E' END || CAST(l_partkey AS STRING) AS lsoa11cd,
               CAST(sum(l_quantity) AS BIGINT) AS reg_popn
        FROM lineitem GROUP BY 1, 2""",
    "v_prac": """
        SELECT 'P' || CAST(s_suppkey AS STRING) AS prac_code, s_name AS prac_name,
               'Y' || CAST(n_regionkey AS STRING) AS nhser_code,
               CASE WHEN s_acctbal BETWEEN 5000 AND 5200 THEN NULL ELSE 'Q' || CAST(s_nationkey AS STRING) END AS icb_code,
               'PC' || CAST(s_suppkey % 50 AS STRING) AS postcode,
               CASE WHEN s_acctbal > 9300 THEN '20200331' END AS close_date,
               CASE WHEN s_acctbal BETWEEN 8800 AND 9300 THEN 'C' ELSE 'A' END AS status_code,
               CASE WHEN s_acctbal < -500 THEN 9 ELSE 4 END AS presc_code
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "v_member": """
        SELECT 'P' || CAST(s_suppkey AS STRING) AS prac_code,
               CASE WHEN s_acctbal BETWEEN 7000 AND 7800 THEN NULL ELSE 'U' || CAST(s_nationkey AS STRING) END AS pcn_code
        FROM supplier""",
    "v_pcn": """
        SELECT 'U' || CAST(n_nationkey AS STRING) AS pcn_code, 'Group of ' || n_name AS pcn_name,
               'L' || CAST(n_nationkey AS STRING) AS loc_code,
               CASE WHEN n_nationkey = 3 THEN '20210630' END AS close_date,
               'PC' || CAST(n_nationkey AS STRING) AS postcode
        FROM nation""",
    "v_loc": """
        SELECT 'L' || CAST(n_nationkey AS STRING) AS loc22cd, 'E5' || CAST(n_nationkey AS STRING) AS icb22ons,
               'Q' || CAST(n_nationkey AS STRING) AS icb22cd, n_name AS icb22nm,
               'Y' || CAST(n_regionkey AS STRING) AS nhser22cd, r_name AS nhser22nm
        FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL
        SELECT 'M' || CAST(n_nationkey AS STRING), 'E5' || CAST(n_nationkey AS STRING),
               'Q' || CAST(n_nationkey AS STRING), n_name, 'Y' || CAST(n_regionkey AS STRING), r_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_postcode": """
        SELECT DISTINCT CASE WHEN s_suppkey % 50 = 7 THEN 'ZZ' ELSE 'PC' END || CAST(s_suppkey % 50 AS STRING) AS postcode,
               50.0 + CAST(s_suppkey % 50 AS DOUBLE) / 10 AS latitude,
               -5.0 + CAST(s_suppkey % 50 AS DOUBLE) / 10 AS longitude
        FROM supplier""",
    "v_area": """
        SELECT CASE WHEN p_partkey % 20 = 0 THEN 'W' ELSE 'E' END || CAST(p_partkey AS STRING) AS LSOA11CD,
               CASE WHEN p_size = 13 THEN NULL WHEN p_size = 14 THEN 0.0 ELSE CAST(p_size AS DOUBLE) * 100000 END AS Shape__Are
        FROM part""",
    "v_geo": """
        SELECT 'E' || CAST(p_partkey AS STRING) AS geo_code,
               CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS size_score,
               p_retailprice AS price_score
        FROM part""",
    "v_brand_area": """
        SELECT p_brand AS area_group, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS size_score,
               p_retailprice AS price_score
        FROM part""",
    "v_age": """
        SELECT 'P' || CAST(l_suppkey AS STRING) AS prac_code,
               CASE WHEN p_size % 10 = 9 THEN '95+' ELSE CAST(p_size % 10 * 10 AS STRING) END AS age,
               CASE WHEN l_linestatus = 'F' THEN 'females' ELSE 'males' END AS gender,
               CAST(sum(l_quantity) AS BIGINT) AS popn
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
        UNION ALL
        SELECT 'P' || CAST(l_suppkey AS STRING), 'ALL',
               CASE WHEN l_linestatus = 'F' THEN 'females' ELSE 'males' END, CAST(sum(l_quantity) AS BIGINT)
        FROM lineitem GROUP BY 1, 2, 3""",
    "v_prev": """
        SELECT 'P' || CAST(l_suppkey AS STRING) AS PRACTICE_CODE, 'G' || l_returnflag AS GROUP_CODE,
               CASE WHEN l_suppkey % 10 = 3 THEN NULL ELSE CAST(sum(l_quantity) AS BIGINT) END AS REGISTER,
               CASE WHEN l_suppkey % 10 = 4 THEN 0 ELSE CAST(3 * sum(l_quantity + l_linenumber) AS BIGINT) END AS PRACTICE_LIST_SIZE
        FROM lineitem GROUP BY l_suppkey, l_returnflag""",
    "v_ach": """
        SELECT 'P' || CAST(l_suppkey AS STRING) AS PRACTICE_CODE, 'IND' || CAST(l_linenumber AS STRING) AS INDICATOR_CODE,
               CASE WHEN l_discount >= 0.095 THEN 'REGISTER' WHEN l_discount >= 0.085 THEN 'ACHIEVED_POINTS'
                    WHEN l_discount < 0.005 THEN NULL WHEN l_returnflag = 'A' THEN 'NUMERATOR'
                    WHEN l_returnflag = 'N' THEN 'DENOMINATOR' ELSE 'PCAS' END AS MEASURE,
               CAST(sum(l_quantity) AS DOUBLE) AS VALUE
        FROM lineitem GROUP BY 1, 2, 3""",
    "v_staff": """
        SELECT 'P' || CAST(user_id AS STRING) AS prac_code,
               CASE event_type WHEN 'click' THEN 'Admin/Non-Clinical' WHEN 'error' THEN 'Direct Patient Care'
                    WHEN 'purchase' THEN 'GP' WHEN 'signup' THEN 'Nurses' ELSE 'Director' END AS staff_group,
               CASE WHEN value < 7 THEN 'Total' ELSE 'Partners' END AS detailed_staff_role,
               CASE WHEN event_id % 3 = 0 THEN 'Headcount' ELSE 'FTE' END AS measure,
               CASE WHEN count(*) = 2 THEN NULL ELSE sum(value) END AS fte
        FROM events GROUP BY 1, 2, 3, 4""",
    "v_staff_parent": """
        SELECT 'U' || CAST(user_id % 25 AS STRING) AS pcn_code,
               CASE event_type WHEN 'click' THEN 'Admin/Non-Clinical' WHEN 'error' THEN 'Direct Patient Care'
                    WHEN 'purchase' THEN 'GP' WHEN 'signup' THEN 'Nurses' ELSE 'Director' END AS staff_group,
               CASE WHEN value > 60 THEN NULL ELSE value END AS fte
        FROM events""",
    "v_income": """
        SELECT 'P' || CAST(s_suppkey AS STRING) AS prac_code,
               CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS income_per_head_popn
        FROM supplier""",
    "v_income_parent": """
        SELECT 'U' || CAST(s_nationkey AS STRING) AS pcn_code,
               CASE WHEN s_nationkey = 5 THEN 0 ELSE count(*) END AS reg_popn,
               sum(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) AS p7,
               sum(CASE WHEN l_linenumber = 2 THEN l_extendedprice END) AS p8,
               sum(CASE WHEN l_linenumber = 3 THEN l_extendedprice END) AS p9,
               sum(CASE WHEN l_linenumber = 4 THEN l_extendedprice END) AS p10,
               sum(CASE WHEN l_linenumber = 5 THEN l_extendedprice END) AS p11,
               sum(CASE WHEN l_linenumber = 6 AND s_nationkey % 5 > 0 THEN l_extendedprice END) AS p12,
               sum(CASE WHEN l_linenumber = 7 THEN l_extendedprice END) AS p13
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey""",
    "v_map": """
        SELECT 'E' || CAST(p_partkey AS STRING) AS lsoa11cd,
               'N' || CAST(CAST(floor(p_partkey / 2.0) AS BIGINT) AS STRING) AS lsoa21cd,
               CASE WHEN p_size < 5 THEN 'X' WHEN p_size < 10 THEN 'M' WHEN p_size BETWEEN 20 AND 24 THEN 'S'
                    WHEN p_size BETWEEN 40 AND 43 THEN 'XU' ELSE 'U' END AS chgind
        FROM part
        UNION ALL
        SELECT 'E' || CAST(p_partkey AS STRING), 'N' || CAST(CAST(floor(p_partkey / 2.0) AS BIGINT) + 1 AS STRING), 'S'
        FROM part WHERE p_size BETWEEN 20 AND 24""",
    "v_eth": """
        SELECT 'N' || CAST(CAST(floor(p_partkey / 2.0) AS BIGINT) AS STRING) AS lsoa21cd,
               CAST(sum(p_size + p_size % 7 + p_size % 5 + p_size % 3 + p_size % 2) AS BIGINT) AS total_popn,
               CAST(sum(p_size % 7) AS BIGINT) AS asian, CAST(sum(p_size % 5) AS BIGINT) AS black,
               CAST(sum(p_size % 3) AS BIGINT) AS mixed, CAST(sum(p_size) AS BIGINT) AS white,
               CASE WHEN min(p_size) = 3 THEN NULL ELSE CAST(sum(p_size % 2) AS BIGINT) END AS other
        FROM part GROUP BY 1""",
    "v_score": "SELECT 'E' || CAST(p_partkey AS STRING) AS lsoa11cd, "
    + ", ".join(_measure(i + 1, f"{name}_Score") for i, name in enumerate(SCORES))
    + ", p_size AS imd_Rank, p_size % 10 AS imd_Decile FROM part",
    "v_dep_income": _indicator_view("income", 17),
    "v_dep_employment": _indicator_view("employment", 20),
    "v_dep_education": _indicator_view("education", 21),
    "v_dep_health": _indicator_view("health", 24),
    "v_dep_barriers": _indicator_view("barriers", 28),
    "v_dep_environment": _indicator_view("environment", 37),
    "v_feat": """
        SELECT 'P' || CAST(l_suppkey AS STRING) AS org_code, avg(l_quantity) AS f1,
               CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE avg(l_discount) END AS f2, avg(l_tax) AS f3,
               CAST(1.0 AS DOUBLE) AS f4, CAST(count(*) AS DOUBLE) AS f5, sum(l_extendedprice) AS f6
        FROM lineitem GROUP BY l_suppkey""",
    "v_feat_gap": """
        SELECT 'P' || CAST(l_suppkey AS STRING) AS org_code, avg(l_quantity) AS f1,
               CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE avg(l_discount) END AS f2, avg(l_tax) AS f3,
               CAST(1.0 AS DOUBLE) AS f4, CAST(count(*) AS DOUBLE) AS f5, sum(l_extendedprice) AS f6
        FROM lineitem GROUP BY l_suppkey
        UNION ALL
        SELECT 'P999999', NULL, NULL, NULL, NULL, NULL, NULL""",
    "v_cust": """
        SELECT 'C' || CAST(c_custkey AS STRING) AS org_code, max(c_acctbal) AS g1, avg(o_totalprice) AS g2,
               CAST(count(o_orderkey) AS DOUBLE) AS g3, min(o_totalprice) AS g4, max(o_totalprice) AS g5,
               avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS g6
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
}

CONDITIONS = ["ga", "gn", "gr"]
MEASURES = [f"IND{i}" for i in range(1, 8)]
PAYMENTS = ["p7", "p8", "p9", "p10", "p11", "p12", "p13"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stand-in source; the plan is bound to ``sf_dir`` when it is made."""
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if re.search(rf"\b{t}\b", text)}
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **used)


def with_views(sql: str) -> str:
    """SQL text with the views it mentions spelled out in front."""
    named = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    if not named:
        return sql
    parts = ", ".join(f"{v} AS ({VIEWS[v].strip()})" for v in named)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {parts}, {body[5:]}"
    return f"WITH {parts} {body}"
