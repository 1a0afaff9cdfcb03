"""SQL twins of the registered queries, written for DuckDB.

Each is stated over the same stand-in views as its query.  Divisions guard
their denominators, every computed double is rounded, and every ranking names
its tie-break.
"""

from __future__ import annotations

from collections.abc import Sequence

from catalogue.views import MEASURES, PAYMENTS, with_views
from peerlens.plans.names import (
    ETHNIC_GROUPS,
    INDICATORS,
    PARENT_STAFF,
    PRACTICE_STAFF,
    SCORES,
    ZERO_WHEN_MISSING,
    age_features,
    geo_features,
    similarity_features,
)

CONDITIONS = ["ga", "gn", "gr"]
IDS = ["org_code", "org_name", "postcode", "icb_code", "icb_name", "nhser_code", "nhser_name"]
FEATURES = ["f1", "f2", "f3", "f4", "f5", "f6"]
CUSTOMER_FEATURES = ["g1", "g2", "g3", "g4", "g5", "g6"]


def r6(columns: Sequence[str]) -> str:
    return ", ".join(f'round("{c}", 6) AS "{c}"' for c in columns)


def q(columns: Sequence[str]) -> str:
    return ", ".join(f'"{c}"' for c in columns)


def final(ctes: str, source: str, exact: Sequence[str], doubles: Sequence[str]) -> str:
    chosen = ", ".join(part for part in (q(exact), r6(doubles)) if part)
    return f"WITH {ctes} SELECT {chosen} FROM {source}"


# --- pieces -------------------------------------------------------------------------------

BASE = """base AS (
  SELECT r.prac_code, m.pcn_code, r.lsoa11cd, r.reg_popn
  FROM v_reg r LEFT JOIN v_member m ON r.prac_code = m.prac_code WHERE r.lsoa11cd LIKE 'E%')"""

ACTIVE = """active AS (
  SELECT prac_code, prac_name, nhser_code, icb_code, postcode FROM v_prac
  WHERE close_date IS NULL AND status_code = 'A' AND presc_code = 4)"""

ORG_INDEX = f"""{BASE}, {ACTIVE},
region_lookup AS (SELECT DISTINCT icb22cd, icb22nm, nhser22cd, nhser22nm FROM v_loc),
org_index AS (
  SELECT a.prac_code AS org_code, a.prac_name AS org_name, a.postcode, a.icb_code, l.icb22nm AS icb_name,
         a.nhser_code, l.nhser22nm AS nhser_name, p.latitude, p.longitude
  FROM active a
  LEFT JOIN region_lookup l ON a.icb_code IS NOT DISTINCT FROM l.icb22cd AND a.nhser_code IS NOT DISTINCT FROM l.nhser22cd
  LEFT JOIN v_postcode p ON a.postcode = p.postcode
  WHERE a.prac_code IN (SELECT prac_code FROM base))"""

PARENT_INDEX = """parent_index AS (
  SELECT d.pcn_code AS org_code, d.pcn_name AS org_name, d.postcode, l.icb22cd AS icb_code, l.icb22nm AS icb_name,
         l.nhser22cd AS nhser_code, l.nhser22nm AS nhser_name, p.latitude, p.longitude
  FROM v_pcn d LEFT JOIN v_loc l ON d.loc_code = l.loc22cd LEFT JOIN v_postcode p ON d.postcode = p.postcode
  WHERE d.close_date IS NULL)"""


def ages(level: str) -> str:
    """Quartiles over rows repeated by frequency."""
    member = "LEFT JOIN v_member m ON c.prac_code = m.prac_code" if level == "pcn_code" else ""
    key = "m.pcn_code" if level == "pcn_code" else "c.prac_code"
    parts, joined = [], []
    for g in ("females", "males", "persons"):
        parts.append(f"""
expanded_{g} AS (SELECT {level}, age, unnest(range({g})) AS copy FROM summed),
quart_{g} AS (SELECT {level}, quantile_cont(age, 0.25) AS q1_{g}, quantile_cont(age, 0.5) AS median_{g},
              quantile_cont(age, 0.75) AS q3_{g} FROM expanded_{g} GROUP BY {level})""")
        joined.append(f"LEFT JOIN quart_{g} ON t.{level} IS NOT DISTINCT FROM quart_{g}.{level}")
    iqr = ", ".join(f"q3_{g} - q1_{g} AS iqr_{g}" for g in ("females", "males", "persons"))
    quart = ", ".join(f"{s}_{g}" for s in ("q1", "median", "q3") for g in ("females", "males", "persons"))
    return f"""cells AS (
  SELECT f.prac_code, coalesce(TRY_CAST(f.age AS INTEGER), 95) AS age, f.popn AS females, m.popn AS males
  FROM (SELECT * FROM v_age WHERE gender = 'females' AND age <> 'ALL') f
  FULL JOIN (SELECT * FROM v_age WHERE gender = 'males' AND age <> 'ALL') m ON f.prac_code = m.prac_code AND f.age = m.age),
summed AS (
  SELECT {key} AS {level}, c.age, CAST(sum(females) AS BIGINT) AS females, CAST(sum(males) AS BIGINT) AS males,
         CAST(sum(females + males) AS BIGINT) AS persons
  FROM cells c {member} GROUP BY 1, 2),
totals AS (
  SELECT {level}, CAST(sum(females) AS BIGINT) AS popn_females, CAST(sum(males) AS BIGINT) AS popn_males,
         CAST(sum(persons) AS BIGINT) AS popn_persons FROM summed GROUP BY 1),{",".join(parts)},
ages AS (SELECT t.{level}, {quart}, {iqr}, popn_females, popn_males, popn_persons FROM totals t {" ".join(joined)})"""


PREV_ORG = "prev AS (SELECT PRACTICE_CODE" + "".join(
    f", max(CASE WHEN lower(GROUP_CODE) = '{c}' THEN REGISTER * 1.0 / nullif(PRACTICE_LIST_SIZE, 0) END) AS {c}"
    for c in CONDITIONS
) + " FROM v_prev GROUP BY PRACTICE_CODE)"

PREV_PARENT = (
    """prev_rates AS (
  SELECT m.pcn_code, lower(p.GROUP_CODE) AS g,
         coalesce(sum(p.REGISTER), 0) * 1.0 / nullif(coalesce(sum(p.PRACTICE_LIST_SIZE), 0), 0) AS rate
  FROM v_prev p LEFT JOIN v_member m ON p.PRACTICE_CODE = m.prac_code GROUP BY 1, 2),
prev AS (SELECT pcn_code"""
    + "".join(f", max(CASE WHEN g = '{c}' THEN rate END) AS {c}" for c in CONDITIONS)
    + " FROM prev_rates GROUP BY pcn_code)"
)


def achieved(level: str, out: str) -> str:
    member = "LEFT JOIN v_member m ON a.PRACTICE_CODE = m.prac_code" if level == "pcn_code" else ""
    sums = ", ".join(
        f"coalesce(sum(CASE WHEN MEASURE = '{m}' THEN VALUE END), 0) AS {s}"
        for m, s in (("NUMERATOR", "n"), ("DENOMINATOR", "d"), ("PCAS", "x"))
    )
    wide = "".join(f", max(CASE WHEN i = '{i}' THEN n / nullif(d, 0) END) AS {i.lower()}" for i in MEASURES)
    raw = "".join(f", max(CASE WHEN i = '{i}' THEN n / nullif(d + x, 0) END) AS {i.lower()}_raw" for i in MEASURES)
    return f"""ach_sums AS (
  SELECT {level} AS org, INDICATOR_CODE AS i, {sums} FROM v_ach a {member}
  WHERE MEASURE IS NULL OR MEASURE NOT IN ('ACHIEVED_POINTS', 'REGISTER') GROUP BY 1, 2),
ach AS (SELECT org AS {out}{wide}{raw} FROM ach_sums GROUP BY org)"""


ACH_COLUMNS = [i.lower() for i in MEASURES] + [f"{i.lower()}_raw" for i in MEASURES]

STAFF = (
    """staff AS (SELECT prac_code"""
    + "".join(
        f", CASE WHEN count(CASE WHEN staff_group = '{g}' THEN 1 END) = 0 THEN 0 "
        f"ELSE max(CASE WHEN staff_group = '{g}' THEN fte END) END AS {c}"
        for g, c in PRACTICE_STAFF.items()
    )
    + " FROM v_staff WHERE detailed_staff_role = 'Total' AND measure = 'FTE' GROUP BY prac_code)"
)

STAFF_PARENT = (
    """staff AS (SELECT pcn_code"""
    + "".join(
        f", coalesce(sum(CASE WHEN staff_group = '{g}' THEN fte END), 0) AS {c}" for g, c in PARENT_STAFF.items()
    )
    + " FROM v_staff_parent GROUP BY pcn_code)"
)

INCOME_PARENT = (
    "income AS (SELECT pcn_code, ("
    + " + ".join(f"coalesce({p}, 0)" for p in PAYMENTS)
    + ") / nullif(reg_popn, 0) AS income_per_head_popn FROM v_income_parent)"
)

DENSITY = """density AS (
  SELECT b.lsoa11cd AS geo_code, sum(b.reg_popn) / nullif(max(a.Shape__Are) / 1e6, 0) AS popn_per_km2
  FROM base b LEFT JOIN v_area a ON b.lsoa11cd = a.LSOA11CD AND a.LSOA11CD LIKE 'E%' GROUP BY 1)"""


def _poison(column: str) -> str:
    return f"CASE WHEN count({column}) = count(*) THEN sum({column}) END"


ETHNICITY = (
    "eth AS (SELECT m.lsoa11cd AS geo_code"
    + "".join(f", {_poison('e.' + g)} / nullif({_poison('e.total_popn')}, 0) AS {g}" for g in ETHNIC_GROUPS)
    + " FROM v_map m LEFT JOIN v_eth e ON m.lsoa21cd = e.lsoa21cd WHERE m.chgind <> 'X' GROUP BY 1)"
)

INDICATOR_NAMES = [n for names in INDICATORS.values() for n in names]


def _indicator(name: str, missing_rows: str) -> str:
    """Zero-filled inside its own table; an area the table does not list stays missing."""
    if name in ZERO_WHEN_MISSING:
        return f"CASE WHEN {missing_rows}.lsoa11cd IS NOT NULL THEN coalesce({missing_rows}.{name}, 0) END AS {name}"
    return f"{missing_rows}.{name}"


DEPRIVATION = (
    "dep AS (SELECT s.lsoa11cd AS geo_code, "
    + ", ".join(f"s.{n}_Score AS {n}" for n in SCORES)
    + ", "
    + ", ".join(_indicator(n, f"v_dep_{t}") for t, names in INDICATORS.items() for n in names)
    + " FROM v_score s "
    + " ".join(f"LEFT JOIN v_dep_{t} ON s.lsoa11cd = v_dep_{t}.lsoa11cd" for t in INDICATORS)
    + ")"
)


def means(name: str, weights: str, areas: str, org: str, metrics: Sequence[str]) -> str:
    columns = ", ".join(
        f"sum(w.reg_popn * a.{m}) / nullif(coalesce(sum(CASE WHEN a.{m} IS NOT NULL THEN w.reg_popn END), 0), 0) AS {m}"
        for m in metrics
    )
    return f"{name} AS (SELECT w.{org} AS org_code, {columns} FROM {weights} w JOIN {areas} a ON w.lsoa11cd = a.geo_code GROUP BY 1)"


PARENT_WEIGHTS = """parent_base AS (
  SELECT pcn_code, lsoa11cd, coalesce(sum(reg_popn), 0) AS reg_popn FROM base GROUP BY 1, 2)"""

AREAS = (
    "areas AS (SELECT d.geo_code, d.popn_per_km2, "
    + ", ".join(f"e.{g}" for g in ETHNIC_GROUPS)
    + ", "
    + ", ".join(f"p.{n}" for n in SCORES + INDICATOR_NAMES)
    + " FROM density d LEFT JOIN eth e ON d.geo_code = e.geo_code LEFT JOIN dep p ON d.geo_code = p.geo_code)"
)


def scaled(name: str, source: str, key: str, columns: Sequence[str], zero: bool = False) -> str:
    def z(c: str) -> str:
        x = f'coalesce("{c}", 0)' if zero else f'"{c}"'
        value = (
            f"CASE WHEN min({x}) OVER () <> max({x}) OVER () "
            f"THEN ({x} - avg({x}) OVER ()) / nullif(stddev_samp({x}) OVER (), 0) END"
        )
        return f'coalesce({value}, 0) AS "{c}"' if zero else f'{value} AS "{c}"'

    return f'{name} AS (SELECT "{key}" AS org_code, {", ".join(z(c) for c in columns)} FROM {source})'


def pairs(source: str, columns: Sequence[str]) -> str:
    long = " UNION ALL ".join(f"SELECT org_code, {i} AS m, \"{c}\" AS z FROM {source}" for i, c in enumerate(columns))
    return f"""long AS ({long}),
pairs AS (
  SELECT a.org_code AS orig, b.org_code AS dest,
         sqrt(sum((a.z - b.z) * (a.z - b.z)) * {len(columns)} / nullif(count(a.z - b.z), 0)) AS distance
  FROM long a JOIN long b ON a.m = b.m AND a.org_code <> b.org_code GROUP BY 1, 2)"""


NEAR = "row_number() OVER (PARTITION BY orig ORDER BY round(distance, 9) ASC NULLS LAST, dest ASC)"
FAR = "row_number() OVER (PARTITION BY orig ORDER BY round(distance, 9) DESC NULLS FIRST, dest DESC)"


def top(order: str, name: str | None = None) -> str:
    label = f"'{name}' AS list, " if name else ""
    return (
        f"SELECT {label}orig, dest, round(distance, 6) AS distance, CAST(place AS INTEGER) AS place "
        f"FROM (SELECT *, {order} AS place FROM pairs) WHERE place <= 10"
    )


FEATURE_PAIRS = scaled("z", "v_feat", "org_code", FEATURES) + ", " + pairs("z", FEATURES)
GAP_PAIRS = scaled("z", "v_feat_gap", "org_code", FEATURES) + ", " + pairs("z", FEATURES)
CUSTOMER_PAIRS = scaled("z", "v_cust", "org_code", CUSTOMER_FEATURES) + ", " + pairs("z", CUSTOMER_FEATURES)

POINTS = scaled("points", "v_feat", "org_code", FEATURES, zero=True)


def full(level: str) -> tuple[str, list[str], list[str]]:
    """The whole index of one level, unrounded, as CTEs ending in ``wide``."""
    practice = level == "practice"
    org = "prac_code" if practice else "pcn_code"
    index, name = (ORG_INDEX, "org_index") if practice else (f"{BASE}, {PARENT_INDEX}", "parent_index")
    blocks = [
        index,
        ages(org),
        PREV_ORG if practice else PREV_PARENT,
        achieved("PRACTICE_CODE" if practice else "pcn_code", "org"),
        STAFF if practice else STAFF_PARENT,
        "income AS (SELECT * FROM v_income)" if practice else INCOME_PARENT,
        DENSITY,
        ETHNICITY,
        DEPRIVATION,
        AREAS,
        means("geo", "base", "areas", org, geo_features()),
    ]
    staff = list(PRACTICE_STAFF.values())
    chosen = [f"o.{c} AS {c.upper()}" for c in [*IDS, "latitude", "longitude"]]
    chosen += ["a.popn_persons AS POPN"]
    chosen += [f"a.{c}" for c in age_features()] + [f"v.{c}" for c in CONDITIONS] + [f"h.{c}" for c in ACH_COLUMNS]
    chosen += [f"s.{c}" for c in staff] + ["i.income_per_head_popn"] + [f"g.{c}" for c in geo_features()]
    prev_key = "PRACTICE_CODE" if practice else "pcn_code"
    blocks.append(
        f"wide AS (SELECT {', '.join(chosen)} FROM {name} o LEFT JOIN ages a ON o.org_code = a.{org} "
        f"LEFT JOIN prev v ON o.org_code = v.{prev_key} LEFT JOIN ach h ON o.org_code = h.org "
        f"LEFT JOIN staff s ON o.org_code = s.{org} LEFT JOIN income i ON o.org_code = i.{org} "
        f"LEFT JOIN geo g ON o.org_code = g.org_code)"
    )
    popn = [c for c in age_features() if c.startswith("popn_")]
    exact = [c.upper() for c in IDS] + ["POPN", *popn]
    doubles = ["LATITUDE", "LONGITUDE"] + [c for c in age_features() if c not in popn] + CONDITIONS + ACH_COLUMNS
    doubles += staff + ["income_per_head_popn"] + geo_features()
    return ", ".join(blocks), exact, doubles


FULL_CTES, FULL_EXACT, FULL_DOUBLES = full("practice")
PARENT_CTES, PARENT_EXACT, PARENT_DOUBLES = full("parent")
SIMILAR = similarity_features(CONDITIONS)

AGE_DOUBLES = [c for c in age_features() if not c.startswith("popn_")]
AGE_COUNTS = [c for c in age_features() if c.startswith("popn_")]


def sums(rule: str) -> str:
    columns = ", ".join(f"round({rule.format(c=c)}, 6) AS {c}" for c in ("size_score", "price_score"))
    return f"SELECT area_group, {columns} FROM v_brand_area GROUP BY 1"


def lloyd(columns: Sequence[str], runs: Sequence[tuple[int, int]], iterations: int = 20) -> str:
    """All runs ``(k, seed)`` of k-means over ``points``, iteration by iteration, as CTEs.

    They end in ``labels`` (org_code, run, c, d: squared distance), ``fits``
    (run, k, seed, cost) and ``vectors`` (org_code, v).
    """
    listed = ", ".join(f"({i}, {k}, {seed})" for i, (k, seed) in enumerate(runs))
    steps = [
        f"vectors AS MATERIALIZED (SELECT org_code, [{q(columns)}] AS v FROM points)",
        "pts AS MATERIALIZED (SELECT min(org_code) AS key, count(*) AS copies, v FROM vectors GROUP BY v)",
        f"runs(run, k, seed) AS (VALUES {listed})",
        """c0 AS MATERIALIZED (SELECT run, place AS c, v FROM (
             SELECT run, k, v, row_number() OVER (PARTITION BY run ORDER BY md5(seed || ':' || key), key) AS place
             FROM pts JOIN runs ON true) WHERE place <= k)""",
    ]
    for i in range(iterations):
        steps += [
            f"""n{i} AS MATERIALIZED (SELECT run, c, v, copies FROM (
                  SELECT c{i}.run, c, pts.v, copies,
                         row_number() OVER (PARTITION BY c{i}.run, key ORDER BY list_distance(pts.v, c{i}.v), c) AS place
                  FROM pts JOIN c{i} ON true) WHERE place = 1)""",
            f"""m{i} AS (SELECT run, c, list(x ORDER BY j) AS v FROM (
                  SELECT run, c, j, sum(copies * x) / sum(copies) AS x
                  FROM (SELECT run, c, copies, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM n{i})
                  GROUP BY run, c, j) GROUP BY run, c)""",
            f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.run, c{i}.c, coalesce(m{i}.v, c{i}.v) AS v
                  FROM c{i} LEFT JOIN m{i} ON c{i}.run = m{i}.run AND c{i}.c = m{i}.c)""",
        ]
    last = f"c{iterations}"
    steps += [
        f"""labels AS MATERIALIZED (SELECT org_code, run, c, dist * dist AS d FROM (
              SELECT org_code, {last}.run, c, list_distance(vectors.v, {last}.v) AS dist,
                     row_number() OVER (PARTITION BY {last}.run, org_code ORDER BY list_distance(vectors.v, {last}.v), c) AS place
              FROM vectors JOIN {last} ON true) WHERE place = 1)""",
        "fits AS (SELECT run, k, seed, sum(d) AS cost FROM labels JOIN runs USING (run) GROUP BY ALL)",
    ]
    return ", ".join(steps)


def best_clusters(key: str) -> str:
    """The labels of the best run, numbered by size and smallest key."""
    return f"""best AS (SELECT run FROM fits ORDER BY round(cost, 9), seed LIMIT 1),
        chosen AS (SELECT org_code, c FROM labels WHERE run = (SELECT run FROM best)),
        numbered AS (SELECT c, row_number() OVER (ORDER BY count(*) DESC, min(org_code)) AS cluster FROM chosen GROUP BY c)
        SELECT org_code AS "{key}", CAST(cluster AS INTEGER) AS cluster FROM chosen JOIN numbered USING (c)"""


STARTS = [(5, s) for s in range(1, 21)]
SWEEP = [(k, 1) for k in range(2, 11)]

EMBEDDED = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"

_PALETTE = ["#E41A1C", "#377EB8", "#4DAF4A", "#984EA3", "#FF7F00", "#FFFF33", "#A65628"]
_NOTICE = (
    "Source: Office for National Statistics licensed under the Open Government Licence v.3.0"
    "<br>Contains OS data © Crown copyright and database right [2023]"
)

# Popup labels, style and notice of the markers.
MAP_LAYER = f"""WITH {ORG_INDEX},
        people AS (SELECT prac_code, CAST(sum(reg_popn) AS BIGINT) AS popn FROM base GROUP BY 1),
        markers AS (SELECT o.*, p.popn, CAST(p.popn % 7 + 1 AS INTEGER) AS cluster
                    FROM org_index o LEFT JOIN people p ON o.org_code = p.prac_code)
        SELECT org_code AS ORG_CODE, org_name AS ORG_NAME, postcode AS POSTCODE, popn AS POPN, icb_code AS ICB_CODE,
               icb_name AS ICB_NAME, nhser_code AS NHSER_CODE, nhser_name AS NHSER_NAME,
               round(latitude, 6) AS LATITUDE, round(longitude, 6) AS LONGITUDE, cluster,
               CAST(cluster AS STRING) AS layer,
               CASE cluster {" ".join(f"WHEN {i + 1} THEN '{c}'" for i, c in enumerate(_PALETTE))} END AS fill_color,
               'Practice: ' || coalesce(org_name, 'NA') || ' - [' || coalesce(org_code, 'NA') || ']<br>' ||
               'ICB: ' || coalesce(icb_name, 'NA') || ' - [' || coalesce(icb_code, 'NA') || ']<br>' ||
               'Region: ' || coalesce(nhser_name, 'NA') || ' - [' || coalesce(nhser_code, 'NA') || ']<br>' ||
               'Popn: ' || coalesce(format('{{:,}}', popn), 'NA') AS popup,
               1 AS weight, 5 AS radius, 'black' AS color, CAST(0.8 AS DOUBLE) AS fill_opacity,
               '{_NOTICE}' AS attribution FROM markers"""

_RAW: dict[str, str] = {
    "scan_project_rename": """
        SELECT CAST(s_suppkey AS STRING) AS org_code, s_name AS org_name, round(s_acctbal, 6) AS balance,
               round(s_acctbal / 1000, 6) AS balance_k, s_acctbal > 0 AS in_credit FROM supplier""",
    "csv_roundtrip": """
        SELECT s_suppkey AS org_key, s_name AS org_name, s_acctbal AS balance, 'headed' AS kind FROM supplier
        UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'headless' FROM supplier""",
    "multi_file_union": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_linenumber <> 7 THEN l_tax END AS l_tax
        FROM lineitem""",
    "extracts_union": """
        SELECT l_orderkey AS order_key, l_linenumber AS line, l_quantity AS quantity,
               CASE WHEN l_linenumber <> 7 THEN l_tax END AS tax FROM lineitem""",
    "age_union": "SELECT prac_code, age, popn, gender FROM v_age",
    "snapshot_refresh": f"WITH {GAP_PAIRS} {top(NEAR)}",
    "active_filter": f"WITH {ACTIVE} SELECT * FROM active",
    "prefix_filter_dq": """
        SELECT count(*) AS n_rows, count(*) - count(CASE WHEN lsoa11cd LIKE 'E%' THEN 1 END) AS n_removed,
               printf('Rows removed: %d (%.2f%%)', count(*) - count(CASE WHEN lsoa11cd LIKE 'E%' THEN 1 END),
                      (count(*) - count(CASE WHEN lsoa11cd LIKE 'E%' THEN 1 END)) * 100.0 / count(*)) AS report
        FROM v_reg""",
    "not_in_keep_null": """
        SELECT PRACTICE_CODE, INDICATOR_CODE, MEASURE, round(VALUE, 6) AS VALUE FROM v_ach
        WHERE INDICATOR_CODE <> 'IND7' AND (MEASURE IS NULL OR MEASURE NOT IN ('ACHIEVED_POINTS', 'REGISTER'))""",
    "pattern_select": "SELECT lsoa11cd, "
    + ", ".join(f"round({n}_Score, 6) AS {n}" for n in SCORES)
    + " FROM v_score",
    "reorder_rename_keep": f"WITH {ORG_INDEX}, {ages('prac_code')} SELECT "
    + ", ".join(f"o.{c} AS {c.upper()}" for c in IDS)
    + ", round(o.latitude, 6) AS LATITUDE, round(o.longitude, 6) AS LONGITUDE, a.popn_persons AS POPN, "
    + ", ".join(f"round(a.{c}, 6) AS {c}" for c in AGE_DOUBLES if not c.startswith("iqr"))
    + ", "
    + ", ".join(f"a.{c}" for c in AGE_COUNTS)
    + " FROM org_index o LEFT JOIN ages a ON o.org_code = a.prac_code",
    "registration_base": f"WITH {BASE} SELECT * FROM base",
    "org_index": final(ORG_INDEX, "org_index", IDS, ["latitude", "longitude"]),
    "parent_index": final(PARENT_INDEX, "parent_index", IDS, ["latitude", "longitude"]),
    "null_safe_join": """
        SELECT m.prac_code, m.pcn_code, s.n_members FROM v_member m
        LEFT JOIN (SELECT pcn_code, count(*) AS n_members FROM v_member GROUP BY pcn_code) s
        ON m.pcn_code IS NOT DISTINCT FROM s.pcn_code""",
    "feature_join_guard": f"""WITH {PREV_ORG}
        SELECT p.prac_code AS org_code, p.prac_name, round(ga, 6) AS ga, round(gn, 6) AS gn, round(gr, 6) AS gr,
               'GA' AS refused FROM v_prac p LEFT JOIN prev ON p.prac_code = prev.PRACTICE_CODE""",
    "multi_left_join_unpivot": f"WITH {DEPRIVATION} "
    + " UNION ALL ".join(
        f"SELECT geo_code AS lsoa11cd, '{n}' AS metric, round({n}, 6) AS value FROM dep" for n in INDICATOR_NAMES
    ),
    "sum_ignore_null": sums("coalesce(sum({c}), 0)"),
    "sum_poison_null": sums("CASE WHEN count({c}) = count(*) THEN sum({c}) END"),
    "apportion_org": f"WITH {BASE}, {means('m', 'base', 'v_geo', 'prac_code', ['size_score', 'price_score'])} "
    + " UNION ALL ".join(
        f"SELECT org_code, '{c}' AS metric, round({c}, 6) AS value FROM m" for c in ("size_score", "price_score")
    ),
    "apportion_parent": f"WITH {BASE}, {PARENT_WEIGHTS}, "
    f"{means('m', 'parent_base', 'v_geo', 'pcn_code', ['size_score', 'price_score'])} "
    + " UNION ALL ".join(
        f"SELECT org_code, '{c}' AS metric, round({c}, 6) AS value FROM m" for c in ("size_score", "price_score")
    ),
    "density_apportion": final(
        f"{BASE}, {DENSITY}, {means('m', 'base', 'density', 'prac_code', ['popn_per_km2'])}",
        "m", ["org_code"], ["popn_per_km2"],
    ),
    "area_remap_share": f"WITH {ETHNICITY} "
    + " UNION ALL ".join(f"SELECT geo_code, '{g}' AS metric, round({g}, 6) AS value FROM eth" for g in ETHNIC_GROUPS),
    "ethnicity_apportion": final(
        f"{BASE}, {PARENT_WEIGHTS}, {ETHNICITY}, {means('m', 'parent_base', 'eth', 'pcn_code', ETHNIC_GROUPS)}",
        "m", ["org_code"], ETHNIC_GROUPS,
    ),
    "deprivation_apportion": final(
        f"{BASE}, {DEPRIVATION}, {means('m', 'base', 'dep', 'prac_code', SCORES + INDICATOR_NAMES)}",
        "m", ["org_code"], SCORES + INDICATOR_NAMES,
    ),
    "age_quartiles_org": final(ages("prac_code"), "ages", ["prac_code", *AGE_COUNTS], AGE_DOUBLES),
    "age_quartiles_parent": final(ages("pcn_code"), "ages", ["pcn_code", *AGE_COUNTS], AGE_DOUBLES),
    "prevalence_org": final(PREV_ORG, "prev", ["PRACTICE_CODE"], CONDITIONS),
    "prevalence_parent": final(PREV_PARENT, "prev", ["pcn_code"], CONDITIONS),
    "achievement_org": final(achieved("PRACTICE_CODE", "practice_code"), "ach", ["practice_code"], ACH_COLUMNS),
    "achievement_parent": final(achieved("pcn_code", "pcn_code"), "ach", ["pcn_code"], ACH_COLUMNS),
    "workforce_pivot_fill": final(STAFF, "staff", ["prac_code"], list(PRACTICE_STAFF.values())),
    "workforce_parent": final(STAFF_PARENT, "staff", ["pcn_code"], list(PARENT_STAFF.values())),
    "income_rowwise": final(INCOME_PARENT, "income", ["pcn_code"], ["income_per_head_popn"]),
    "standardise": final(scaled("z", "v_feat", "org_code", FEATURES), "z", ["org_code"], FEATURES),
    "pairwise_distance": f"WITH {FEATURE_PAIRS} SELECT orig, dest, round(distance, 6) AS distance FROM pairs",
    "nearest_10": f"WITH {GAP_PAIRS} {top(NEAR)}",
    "farthest_10": f"WITH {GAP_PAIRS} {top(FAR)}",
    "nearest_10_block": f"""WITH {EMBEDDED}, pairs AS (
        SELECT a.vec_id AS orig, b.vec_id AS dest, list_distance(a.v, b.v) AS distance
        FROM e a JOIN e b ON a.vec_id <> b.vec_id) {top(NEAR)}""",
    "neighbours_customer": f"WITH {CUSTOMER_PAIRS} {top(NEAR, 'nearest')} UNION ALL {top(FAR, 'farthest')}",
    "kmeans_assign_fixed": f"""WITH {POINTS},
        seeds AS (SELECT *, row_number() OVER (ORDER BY org_code) - 1 AS s FROM points ORDER BY org_code LIMIT 3),
        costs AS (SELECT p.org_code, s.s, {" + ".join(f"(p.{f} - s.{f}) * (p.{f} - s.{f})" for f in FEATURES)} AS d
                  FROM points p JOIN seeds s ON true),
        nearest AS (SELECT org_code, s, d FROM (
            SELECT *, row_number() OVER (PARTITION BY org_code ORDER BY d, s) AS place FROM costs) WHERE place = 1),
        numbered AS (SELECT s, row_number() OVER (ORDER BY count(*) DESC, min(org_code)) AS cluster FROM nearest GROUP BY s)
        SELECT n.org_code, CAST(m.cluster AS INTEGER) AS cluster, round(n.d, 6) AS squared_distance
        FROM nearest n JOIN numbered m ON n.s = m.s""",
    "total_ss": f"WITH {POINTS} SELECT round(sum({' + '.join(f'{f} * {f}' for f in FEATURES)}), 6) AS wss FROM points",
    "kmeans_best_of": f"WITH {POINTS}, {lloyd(FEATURES, STARTS)}, {best_clusters('org_code')}",
    "wss_sweep": f"""WITH {POINTS}, {lloyd(FEATURES, SWEEP)}
        SELECT k, round(cost, 6) AS wss FROM fits
        UNION ALL SELECT 1, round(sum({' + '.join(f'{f} * {f}' for f in FEATURES)}), 6) FROM points""",
    "silhouette_sweep": f"""WITH {POINTS}, {lloyd(FEATURES, SWEEP)},
        apart AS (SELECT a.org_code AS x, b.org_code AS y, list_distance(a.v, b.v) AS dist
                  FROM vectors a JOIN vectors b ON a.org_code <> b.org_code),
        means AS (SELECT x, p.run, p.c AS own, o.c AS other, sum(dist) / count(*) AS m
                  FROM apart JOIN labels p ON p.org_code = x JOIN labels o ON o.org_code = y AND o.run = p.run GROUP BY ALL),
        sides AS (SELECT x, run, max(CASE WHEN own = other THEN m END) AS a, min(CASE WHEN own <> other THEN m END) AS b
                  FROM means GROUP BY ALL)
        SELECT k, round(avg(CASE WHEN a IS NULL THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END), 6)
               AS mean_silhouette FROM sides JOIN runs USING (run) GROUP BY k
        UNION ALL SELECT 1, 0""",
    "silhouette_labels": f"""WITH {EMBEDDED},
        d AS (SELECT a.vec_id AS key, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) / count(*) AS m
              FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
        s AS (SELECT key, own, max(CASE WHEN own = other THEN m END) AS a, min(CASE WHEN own <> other THEN m END) AS b
              FROM d GROUP BY 1, 2)
        SELECT key, own AS label, round(CASE WHEN a IS NULL THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END, 6)
               AS width FROM s""",
    "map_layer": MAP_LAYER,
    "map_layer_of_cluster": f"SELECT * FROM ({MAP_LAYER}) WHERE cluster = 3",
    "full_index": final(FULL_CTES, "wide", FULL_EXACT, FULL_DOUBLES),
    "full_index_parent": final(PARENT_CTES, "wide", PARENT_EXACT, PARENT_DOUBLES),
    "index_neighbours": f"WITH {FULL_CTES}, {scaled('z', 'wide', 'ORG_CODE', SIMILAR)}, {pairs('z', SIMILAR)} "
    f"{top(NEAR, 'nearest')} UNION ALL {top(FAR, 'farthest')}",
    "index_neighbours_parent": f"WITH {PARENT_CTES}, {scaled('z', 'wide', 'ORG_CODE', SIMILAR)}, {pairs('z', SIMILAR)} "
    f"{top(NEAR, 'nearest')} UNION ALL {top(FAR, 'farthest')}",
    "index_clusters": f"WITH {FULL_CTES}, {scaled('points', 'wide', 'ORG_CODE', SIMILAR, zero=True)}, "
    f"{lloyd(SIMILAR, [(7, s) for s in range(1, 21)])}, {best_clusters('ORG_CODE')}",
    "index_clusters_parent": f"WITH {PARENT_CTES}, {scaled('points', 'wide', 'ORG_CODE', SIMILAR, zero=True)}, "
    f"{lloyd(SIMILAR, [(5, s) for s in range(1, 21)])}, {best_clusters('ORG_CODE')}",
}

_RAW["csv_quarantine"] = """WITH rows AS (
        SELECT s_acctbal AS balance, CASE WHEN s_suppkey % 17 = 3 THEN '2 fields, not 3' WHEN s_suppkey % 19 = 4
            THEN '4 fields, not 3' WHEN s_suppkey % 23 = 5 THEN 'balance is no double' ELSE 'ok' END AS reason FROM supplier)
    SELECT reason, count(*) AS n, round(sum(balance) FILTER (reason = 'ok'), 2) AS balance FROM rows GROUP BY reason"""



def _ranked(share: float, name: str, weight: str) -> str:
    """Interpolated quantile of the values ``v`` with counts ``weight``, each at its last rank ``weight_to``."""
    at = f"(any_value({weight}_all) - 1) * {share}"
    low, high = (f"min(v) FILTER ({weight} > 0 AND {weight}_to > {end}(({weight}_all - 1) * {share}))" for end in ("floor", "ceil"))
    mean = f"(ceil({at}) - {at}) * {low} + ({at} - floor({at})) * {high}"
    return f"CASE WHEN {low} = {high} THEN {low} ELSE {mean} END AS {name}_{weight}"


_RANKS = ", ".join(
    f"sum({w}) OVER (PARTITION BY l_returnflag ORDER BY v) AS {w}_to, sum({w}) OVER (PARTITION BY l_returnflag) AS {w}_all"
    for w in ("sold", "line")
)
_QUANTILES = ", ".join(_ranked(s, n, w) for w in ("sold", "line") for n, s in (("q1", 0.25), ("median", 0.5), ("p99", 0.99)))
_RAW["price_quantiles_ranked"] = f"""WITH c AS (
        SELECT l_returnflag, l_extendedprice AS v, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sold,
               CAST(sum(l_linenumber) AS BIGINT) AS line FROM lineitem GROUP BY 1, 2),
    r AS (SELECT *, {_RANKS} FROM c),
    f AS (SELECT l_returnflag, {_QUANTILES}, CAST(sum(sold) AS BIGINT) AS popn_sold, CAST(sum(line) AS BIGINT) AS popn_line
          FROM r GROUP BY 1)
    SELECT l_returnflag, popn_sold, popn_line, {", ".join(f"round({n}_{w}, 4) AS {n}_{w}" for w in ("sold", "line") for n in ("q1", "median", "p99"))},
           {", ".join(f"round(p99_{w} - q1_{w}, 4) AS spread_{w}" for w in ("sold", "line"))} FROM f"""

# The same results by other ways: most pairs left out, old lists brought up to date, tables saved as a unit, bounds kept.
_RAW |= {
    "nearest_10_balls": _RAW["nearest_10_block"],
    "farthest_10_balls": _RAW["farthest_10"],
    "neighbours_refreshed": f"WITH {GAP_PAIRS} {top(NEAR, 'nearest')} UNION ALL {top(FAR, 'farthest')}",
    "snapshot_unit": _RAW["org_index"],
    "silhouette_sampled": _RAW["silhouette_labels"],
    "silhouette_bounds": "SELECT label % 2 AS label, count(*) AS points, count(*) AS held FROM embeddings GROUP BY 1",
    "indicator_sheets": _RAW["multi_left_join_unpivot"],
    "parent_index_sheets": _RAW["parent_index"],
    "registration_base_sheets": _RAW["registration_base"],
    "density_attributes": _RAW["density_apportion"],
    "kmeans_bounded": f"WITH {POINTS}, {lloyd(FEATURES, [(5, 1)])}, {best_clusters('org_code')}",
}

ORACLES: dict[str, str] = {name: with_views(sql) for name, sql in _RAW.items()}
