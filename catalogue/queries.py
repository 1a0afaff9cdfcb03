"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.views import CONDITIONS, MEASURES, PAYMENTS, table, view
from peerlens.functions.columns import names_containing, pick_positions, quoted, rename_all
from peerlens.functions.missing import not_in_keeping_null
from peerlens.operators import apportion as ap
from peerlens.operators import balls, clustering, neighbours, refresh, seeding, silhouette, silhouette_sample
from peerlens.operators.joins import chain_left, clashing_names, guarded_feature_join, left_lookup
from peerlens.operators.layer import map_layer
from peerlens.operators.reshape import wide_to_long
from peerlens.operators.quantiles import weighted_quantiles_by_rank
from peerlens.operators.rollup import grouped_sums, removal_report
from peerlens.operators.standardise import as_vectors, standardise
from peerlens.plans import geo_features as geo
from peerlens.plans import index as index_plan
from peerlens.plans import org_features as org
from peerlens.plans import organisations as orgs
from peerlens.plans.jobs import CLUSTERS
from peerlens.plans.names import DEPRIVATION, ETHNIC_GROUPS, INDICATORS, similarity_features
from peerlens.sources.attributes import write_attributes
from peerlens.sources.inputs import FIELDS, FIRST_INDICATOR, read_areas, read_fields, read_indicators
from peerlens.sources.quarantine import read_csv_checked
from peerlens.sources.readers import read_csv, read_csv_all, read_csv_parts, read_snapshot, rows_of_layer, union_by_name
from peerlens.sources.sinks import write_csv, write_snapshot, write_snapshots
from peerlens.sources.staging import new_folder, stage
from peerlens.sources.workbooks import Sheet, write_workbooks

Query = Callable[[SparkSession, str], DataFrame]

FEATURES = ["f1", "f2", "f3", "f4", "f5", "f6"]
CUSTOMER_FEATURES = ["g1", "g2", "g3", "g4", "g5", "g6"]
DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Every double rounded, so that two engines' last bits do not matter."""
    return df.selectExpr(
        *[
            f"round({quoted(n)}, {digits}) AS {quoted(n)}" if t in ("double", "float") else quoted(n)
            for n, t in df.dtypes
        ]
    )


# --- sources, projections, filters -------------------------------------------------


def scan_project_rename(spark, sf):
    picked = pick_positions(
        table(spark, sf, "supplier"), [(1, "org_code", "string"), (2, "org_name", "string"), (4, "balance", "double")]
    )
    return rounded(picked.withColumns({"balance_k": F.col("balance") / 1000, "in_credit": F.col("balance") > 0}))


def csv_roundtrip(spark, sf):
    supplier = table(spark, sf, "supplier")
    fields = [(1, "org_key", "bigint"), (2, "org_name", "string"), (4, "balance", "double")]
    parts = []
    for kind, header in (("headed", True), ("headless", False)):
        path = new_folder(spark, "csv")
        write_csv(supplier, path, header=header)
        parts.append(read_csv(spark, path, fields, header=header).withColumn("kind", F.lit(kind)))
    return union_by_name(parts)


def _extracts(spark, sf) -> list[str]:
    """The lines as seven delimited extracts, written in one pass; the last one lacks a column."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("line"), "l_linenumber", "l_partkey", "l_quantity", "l_tax"
    )
    home = new_folder(spark, "extracts")
    write_csv(lines.filter(F.col("l_linenumber") < 7), home, partition_by=["line"])
    write_csv(lines.filter(F.col("l_linenumber") == 7).drop("line", "l_tax"), f"{home}/line=7")
    return [f"{home}/line={n}" for n in range(1, 8)]


def csv_quarantine(spark, sf):
    """Suppliers as text, some lines short, long or mistyped: sums of the good rows, and bad lines by reason."""
    key, text = F.col("s_suppkey"), "concat_ws(',', s_suppkey, {}, s_acctbal)"
    line = (
        F.when(key % 17 == 3, F.expr("concat_ws(',', s_suppkey, s_acctbal)"))
        .when(key % 19 == 4, F.expr(text.format("'a name', 'more'")))
        .when(key % 23 == 5, F.expr("concat_ws(',', s_suppkey, 'a name', 'unknown')"))
        .otherwise(F.expr(text.format("""'"a, name"'""")))
    )
    path = new_folder(spark, "suppliers")
    table(spark, sf, "supplier").select(line).write.text(path)
    found = read_csv_checked(spark, path, [(1, "org_key", "bigint"), (3, "balance", "double")], header=False, most_bad=0.5)
    good = found.rows.agg(F.count(F.lit(1)).alias("n"), F.sum("balance").alias("balance")).withColumn("reason", F.lit("ok"))
    bad = found.bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).withColumn("balance", F.lit(None).cast("double"))
    return rounded(good.unionByName(bad), 2)


def multi_file_union(spark, sf):
    parts = [read_csv_all(spark, path) for path in _extracts(spark, sf)]
    united = union_by_name(parts)
    return united.select(
        F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("int"), F.col("l_partkey").cast("bigint"),
        F.col("l_quantity").cast("double"), F.col("l_tax").cast("double"),
    )


def extracts_union(spark, sf):
    fields = [(1, "order_key", "bigint"), (2, "line", "int"), (4, "quantity", "double"), (5, "tax", "double")]
    return read_csv_parts(spark, _extracts(spark, sf), fields)


def age_union(spark, sf):
    ages = view(spark, sf, "v_age")
    females, males = (ages.filter(F.col("gender") == g).drop("gender") for g in ("females", "males"))
    return org.age_table(females, males)


def snapshot_refresh(spark, sf):
    path = new_folder(spark, "pairs")
    write_snapshot(neighbours.pairwise_distance(_feature_vectors(spark, sf, "v_feat_gap", FEATURES)), path)
    return rounded(neighbours.nearest_from_pairs(read_snapshot(spark, path)))


def snapshot_unit(spark, sf):
    """Two saves of a unit; the second one's table is what a reader gets."""
    folder = new_folder(spark, "unit")
    write_snapshots({"organisations": parent_index(spark, sf)}, folder)
    write_snapshots({"organisations": org_index(spark, sf), "parents": parent_index(spark, sf)}, folder)
    return read_snapshot(spark, f"{folder}/organisations")


def active_filter(spark, sf):
    return orgs.active_practices(view(spark, sf, "v_prac"))


def prefix_filter_dq(spark, sf):
    return removal_report(view(spark, sf, "v_reg"), orgs.is_english("lsoa11cd"))


def not_in_keep_null(spark, sf):
    rows = view(spark, sf, "v_ach").filter(F.col("INDICATOR_CODE") != "IND7")
    return rounded(rows.filter(not_in_keeping_null("MEASURE", ["ACHIEVED_POINTS", "REGISTER"])))


def _scores(spark, sf) -> DataFrame:
    wide = view(spark, sf, "v_score")
    kept = wide.select("lsoa11cd", *names_containing(wide, "score"))
    return rename_all(kept, lambda c: c.replace("_Score", ""))


def pattern_select(spark, sf):
    return rounded(_scores(spark, sf))


def _practice_index(spark, sf) -> DataFrame:
    return orgs.practice_index(
        view(spark, sf, "v_prac"), _base(spark, sf), view(spark, sf, "v_loc"), view(spark, sf, "v_postcode")
    )


def reorder_rename_keep(spark, sf):
    ages = org.age_quartiles(view(spark, sf, "v_age"), "prac_code")
    wide = guarded_feature_join(_practice_index(spark, sf), ages, "org_code", "prac_code")
    return rounded(orgs.display_index(wide, drop=("iqr_females", "iqr_males", "iqr_persons")))


# --- joins ------------------------------------------------------------------------------


def _base(spark, sf) -> DataFrame:
    return orgs.registration_base(view(spark, sf, "v_reg"), view(spark, sf, "v_member"))


def registration_base(spark, sf):
    return _base(spark, sf)


def org_index(spark, sf):
    return rounded(_practice_index(spark, sf))


def parent_index(spark, sf):
    return rounded(orgs.parent_index(view(spark, sf, "v_pcn"), view(spark, sf, "v_loc"), view(spark, sf, "v_postcode")))


def null_safe_join(spark, sf):
    members = view(spark, sf, "v_member")
    sizes = members.groupBy("pcn_code").agg(F.count(F.lit(1)).alias("n_members"))
    return left_lookup(members, sizes, [("pcn_code", "pcn_code")], null_safe=True)


def feature_join_guard(spark, sf):
    index = view(spark, sf, "v_prac").select(F.col("prac_code").alias("org_code"), "prac_name")
    rates = org.prevalence_practice(view(spark, sf, "v_prev"), CONDITIONS)
    joined = guarded_feature_join(index, rates, "org_code", "PRACTICE_CODE")
    again = rates.select(F.col("PRACTICE_CODE").alias("org_code"), F.col("ga").alias("GA"), F.col("gn").alias("other"))
    refused = ",".join(clashing_names(again, joined, "org_code"))
    return rounded(joined.withColumn("refused", F.lit(refused)))


def _indicators(spark, sf) -> dict[str, DataFrame]:
    return {name: view(spark, sf, f"v_dep_{name}") for name in INDICATORS}


def _joined_indicators(spark, sf, tables: dict[str, DataFrame]) -> DataFrame:
    areas = view(spark, sf, "v_score").select("lsoa11cd")
    wide = chain_left(areas, [geo.zero_filled(t) for t in tables.values()], "lsoa11cd")
    return rounded(wide_to_long(wide, ["lsoa11cd"]))


def multi_left_join_unpivot(spark, sf):
    return _joined_indicators(spark, sf, _indicators(spark, sf))


def _at_positions(df: DataFrame, fields: Sequence[tuple[int, str, str]]) -> DataFrame:
    """Named columns at their 1-based positions, empty ones between them."""
    spots = {p: n for p, n, _ in fields}
    empty = F.lit(None).cast("string")
    return df.select(*[F.col(spots[p]) if p in spots else empty.alias(f"c{p}") for p in range(1, max(spots) + 1)])


def indicator_sheets(spark, sf):
    """The six indicator tables as sheets of workbooks, read back by position and joined."""
    path, tables = new_folder(spark, "indicators"), {}
    for name, df in _indicators(spark, sf).items():
        measures = [(FIRST_INDICATOR + i, m, "double") for i, m in enumerate(INDICATORS[name])]
        tables[name] = _at_positions(df, [(1, "lsoa11cd", "string"), *measures])
    write_workbooks(tables, path)
    return _joined_indicators(spark, sf, {n: read_indicators(spark, Sheet(path, n), n) for n in tables})


def _group_sheets(spark, sf) -> dict[str, DataFrame]:
    """Groups and their members from the two sheets of a workbook."""
    path = new_folder(spark, "groups")
    members = view(spark, sf, "v_member").withColumn("close_date", F.lit(None).cast("string"))
    tables = {"parents": view(spark, sf, "v_pcn"), "members": members}
    write_workbooks({n: _at_positions(t, FIELDS[n]) for n, t in tables.items()}, path)
    return {n: read_fields(spark, Sheet(path, n), FIELDS[n]) for n in tables}


def parent_index_sheets(spark, sf):
    parents = _group_sheets(spark, sf)["parents"]
    return rounded(orgs.parent_index(parents, view(spark, sf, "v_loc"), view(spark, sf, "v_postcode")))


def registration_base_sheets(spark, sf):
    members = orgs.open_only(_group_sheets(spark, sf)["members"])
    return orgs.registration_base(view(spark, sf, "v_reg"), members)


# --- aggregates and apportionment ------------------------------------------------------------


def sum_ignore_null(spark, sf):
    return rounded(grouped_sums(view(spark, sf, "v_brand_area"), ["area_group"], ["size_score", "price_score"]))


def sum_poison_null(spark, sf):
    return rounded(
        grouped_sums(view(spark, sf, "v_brand_area"), ["area_group"], ["size_score", "price_score"], missing="poison")
    )


def _geo_long(spark, sf) -> DataFrame:
    return wide_to_long(view(spark, sf, "v_geo"), ["geo_code"])


def apportion_org(spark, sf):
    weights = ap.practice_weights(_base(spark, sf))
    return rounded(ap.apportion(_geo_long(spark, sf), weights, ["size_score", "price_score"]))


def apportion_parent(spark, sf):
    return rounded(ap.apportion(_geo_long(spark, sf), ap.parent_weights(_base(spark, sf)), ["size_score", "price_score"]))


def density_apportion(spark, sf):
    base = _base(spark, sf)
    density = geo.density_by_area(base, view(spark, sf, "v_area"))
    return rounded(ap.apportion_wide(density, ap.practice_weights(base), ["popn_per_km2"]))


def density_attributes(spark, sf):
    """Area sizes from the boundary layer's attribute table instead of a delimited file."""
    path = f"{new_folder(spark, 'boundaries')}.dbf"
    write_attributes(view(spark, sf, "v_area"), path, [("LSOA11CD", "C", 12, 0), ("Shape__Are", "F", 24, 3)])
    base = _base(spark, sf)
    density = geo.density_by_area(base, read_areas(spark, path))
    return rounded(ap.apportion_wide(density, ap.practice_weights(base), ["popn_per_km2"]))


def area_remap_share(spark, sf):
    shares = geo.ethnicity_by_area(view(spark, sf, "v_map"), view(spark, sf, "v_eth"))
    return rounded(wide_to_long(shares, ["geo_code"], ETHNIC_GROUPS))


def ethnicity_apportion(spark, sf):
    shares = geo.ethnicity_by_area(view(spark, sf, "v_map"), view(spark, sf, "v_eth"))
    return rounded(ap.apportion_wide(shares, ap.parent_weights(_base(spark, sf)), ETHNIC_GROUPS))


def deprivation_apportion(spark, sf):
    areas = geo.deprivation_by_area(_scores(spark, sf), _indicators(spark, sf))
    return rounded(ap.apportion_wide(areas, ap.practice_weights(_base(spark, sf)), DEPRIVATION))


# --- organisation features ----------------------------------------------------------------------


def age_quartiles_org(spark, sf):
    return rounded(org.age_quartiles(view(spark, sf, "v_age"), "prac_code"))


def age_quartiles_parent(spark, sf):
    return rounded(org.age_quartiles(view(spark, sf, "v_age"), "pcn_code", view(spark, sf, "v_member")))


def price_quantiles_ranked(spark, sf):
    """Quantiles of prices, where each group has about as many values as rows."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", F.col("l_quantity").alias("sold"), F.col("l_linenumber").alias("line"))
    shares = {"q1": 0.25, "median": 0.5, "p99": 0.99}
    return rounded(
        weighted_quantiles_by_rank(lines, ["l_returnflag"], "l_extendedprice", ["sold", "line"], shares, spread=("spread", "p99", "q1"), most=2000), 4
    )


def prevalence_org(spark, sf):
    return rounded(org.prevalence_practice(view(spark, sf, "v_prev"), CONDITIONS))


def prevalence_parent(spark, sf):
    return rounded(org.prevalence_parent(view(spark, sf, "v_prev"), view(spark, sf, "v_member"), CONDITIONS))


def achievement_org(spark, sf):
    return rounded(org.achievement(view(spark, sf, "v_ach"), "PRACTICE_CODE", MEASURES))


def achievement_parent(spark, sf):
    return rounded(org.achievement(view(spark, sf, "v_ach"), "pcn_code", MEASURES, view(spark, sf, "v_member")))


def workforce_pivot_fill(spark, sf):
    return rounded(org.workforce_practice(view(spark, sf, "v_staff")))


def workforce_parent(spark, sf):
    return rounded(org.workforce_parent(view(spark, sf, "v_staff_parent")))


def income_rowwise(spark, sf):
    return rounded(org.income_parent(view(spark, sf, "v_income_parent"), PAYMENTS))


# --- similarity ------------------------------------------------------------------------------------


def standardise_features(spark, sf):
    return rounded(standardise(view(spark, sf, "v_feat"), ["org_code"], FEATURES))


def _feature_vectors(spark, sf, name: str, columns: Sequence[str]) -> DataFrame:
    features = view(spark, sf, name)
    return as_vectors(standardise(features, ["org_code"], columns), "org_code", columns)


def _embeddings(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("key"), F.col("embedding").cast("array<double>").alias("vec"), "label"
    )


def pairwise_distance(spark, sf):
    return rounded(neighbours.pairwise_distance(_feature_vectors(spark, sf, "v_feat", FEATURES)))


def nearest_10(spark, sf):
    return rounded(neighbours.nearest_k(_feature_vectors(spark, sf, "v_feat_gap", FEATURES)))


def farthest_10(spark, sf):
    return rounded(neighbours.farthest_k(_feature_vectors(spark, sf, "v_feat_gap", FEATURES)))


def nearest_10_block(spark, sf):
    return rounded(neighbours.nearest_k(_embeddings(spark, sf).select("key", "vec")))


def neighbours_customer(spark, sf):
    return rounded(neighbours.nearest_and_farthest(_feature_vectors(spark, sf, "v_cust", CUSTOMER_FEATURES)))


def _by_balls(vectors: DataFrame, k: int, wanted: str, ball_rows: int) -> DataFrame:
    """One list found by pruned balls, in the form of the full comparison's."""
    lists = balls.ball_lists(stage(vectors, "vectors"), k, [wanted], ball_rows).lists
    first = neighbours.first_k(lists, k, farthest=wanted == "farthest")
    return rounded(first.select("orig", "dest", "distance", "place"))


def nearest_10_balls(spark, sf):
    return _by_balls(_embeddings(spark, sf).select("key", "vec"), 10, "nearest", ball_rows=128)


def farthest_10_balls(spark, sf):
    return _by_balls(_feature_vectors(spark, sf, "v_feat_gap", FEATURES), 10, "farthest", ball_rows=64)


def neighbours_refreshed(spark, sf):
    """Lists of a table that lacks some rows, has some others and other values, brought up to date."""
    now = stage(_feature_vectors(spark, sf, "v_feat_gap", FEATURES), "vectors")
    turn = F.pmod(F.xxhash64("key"), F.lit(20))
    other = F.when(turn == 1, F.transform("vec", lambda v: v + 1)).otherwise(F.col("vec")).alias("vec")
    left_since = now.where(turn == 2).select(F.concat("key", F.lit("-")).alias("key"), "vec")
    before = stage(now.where(turn != 0).select("key", other).unionByName(left_since), "vectors")
    lists = stage(neighbours.with_rank(neighbours.nearest_and_farthest(before)), "lists")
    return rounded(neighbours.placed(refresh.updated_lists(before, now, lists, 10).lists, 10))


# --- clusters -----------------------------------------------------------------------------------------


def _cluster_vectors(spark, sf) -> DataFrame:
    return stage(clustering.cluster_input(view(spark, sf, "v_feat"), "org_code", FEATURES), "points")


def kmeans_assign_fixed(spark, sf):
    vectors = _cluster_vectors(spark, sf)
    assigned = clustering.assign_to_centroids(vectors, clustering.lowest_key_centroids(vectors, 3))
    labelled = clustering.canonical_labels(assigned, "nearest")
    return rounded(labelled.select(F.col("key").alias("org_code"), "cluster", "squared_distance"))


def kmeans_best_of(spark, sf):
    return clustering.kmeans_best_of(_cluster_vectors(spark, sf), k=5).withColumnRenamed("key", "org_code")


def kmeans_bounded(spark, sf):
    """One start's iteration by bounds; the same start as the first of ``kmeans_best_of``."""
    points = _cluster_vectors(spark, sf)
    starts = clustering.hash_starts(clustering.distinct_points(points), [(5, 1)])[0]
    fit = seeding.bounded_fit(points, starts).fit
    return clustering.labelled_by(points, fit).withColumnRenamed("key", "org_code")


def total_ss(spark, sf):
    return rounded(clustering.total_sum_of_squares(_cluster_vectors(spark, sf)))


def wss_sweep(spark, sf):
    return rounded(clustering.wss_sweep(_cluster_vectors(spark, sf)))


def silhouette_labels(spark, sf):
    return rounded(silhouette.silhouette_of_labels(_embeddings(spark, sf), "label"))


def silhouette_sampled(spark, sf):
    """Widths by samples; clusters that are smaller than their sample come out exact."""
    points = table(spark, sf, "embeddings").selectExpr("vec_id AS key", "embedding AS vec", "label")
    return rounded(silhouette_sample.sampled_silhouettes(points, "label").select("key", "label", "width"))


def silhouette_bounds(spark, sf):
    """How many exact widths lie in the intervals of coarse samples; two clusters, larger than their samples."""
    points = table(spark, sf, "embeddings").selectExpr("vec_id AS key", "embedding AS vec", "label % 2 AS label")
    exact = silhouette.silhouette_of_labels(points, "label").select("key", F.col("width").alias("exact"))
    found = silhouette_sample.sampled_silhouettes(points, "label", epsilon=0.9, delta=0.05).join(exact, "key")
    held = F.col("exact").between(F.col("low") - 1e-9, F.col("high") + 1e-9)
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("points"), F.count_if(held).alias("held"))


def silhouette_sweep(spark, sf):
    return rounded(silhouette.silhouette_sweep(_cluster_vectors(spark, sf)))


def map_layer_rows(spark, sf):
    people = _base(spark, sf).groupBy("prac_code").agg(F.sum("reg_popn").alias("popn_persons"))
    wide = guarded_feature_join(_practice_index(spark, sf), people, "org_code", "prac_code")
    index = orgs.display_index(wide)
    clusters = index.select("ORG_CODE", (F.col("POPN") % 7 + 1).cast("int").alias("cluster"))
    return rounded(map_layer(index, clusters))


def map_layer_of_cluster(spark, sf):
    path = new_folder(spark, "map")
    write_snapshot(map_layer_rows(spark, sf), path, ["cluster"])
    return rows_of_layer(spark, path, 3)


# --- whole jobs --------------------------------------------------------------------------------------------


def sources(spark: SparkSession, sf: str) -> index_plan.Sources:
    """All sources of the index job, from the stand-in views."""

    def v(name: str) -> DataFrame:
        return view(spark, sf, name)

    return index_plan.Sources(
        registrations=v("v_reg"), practices=v("v_prac"), parents=v("v_pcn"), members=v("v_member"),
        locations=v("v_loc"), postcodes=v("v_postcode"), areas=v("v_area"), ages=v("v_age"),
        prevalence=v("v_prev"), achievement=v("v_ach"), practice_income=v("v_income"),
        parent_income=v("v_income_parent"), practice_staff=v("v_staff"), parent_staff=v("v_staff_parent"),
        ethnicity=v("v_eth"), area_map=v("v_map"), scores=_scores(spark, sf), indicators=_indicators(spark, sf),
        conditions=CONDITIONS, measures=MEASURES, payments=PAYMENTS,
    )


def _practice_table(spark, sf) -> DataFrame:
    s = sources(spark, sf)
    return index_plan.practice_table(s, index_plan.stored_area_sums(s))


def full_index(spark, sf):
    return rounded(_practice_table(spark, sf))


def full_index_parent(spark, sf):
    return rounded(_parent_table(spark, sf))


def _parent_table(spark, sf) -> DataFrame:
    s = sources(spark, sf)
    return index_plan.parent_table(s, index_plan.stored_area_sums(s))


def _neighbours_of(wide: DataFrame) -> DataFrame:
    features = similarity_features(CONDITIONS)
    index = stage(wide.select("ORG_CODE", *features), "index")
    vectors = as_vectors(standardise(index, ["ORG_CODE"], features), "ORG_CODE", features)
    return rounded(neighbours.nearest_and_farthest(vectors))


def _clusters_of(wide: DataFrame, k: int) -> DataFrame:
    features = similarity_features(CONDITIONS)
    index = stage(wide.select("ORG_CODE", *features), "index")
    points = stage(clustering.cluster_input(index, "ORG_CODE", features), "points")
    return clustering.kmeans_best_of(points, k=k).withColumnRenamed("key", "ORG_CODE")


def index_neighbours(spark, sf):
    return _neighbours_of(_practice_table(spark, sf))


def index_neighbours_parent(spark, sf):
    return _neighbours_of(_parent_table(spark, sf))


def index_clusters(spark, sf):
    return _clusters_of(_practice_table(spark, sf), CLUSTERS["practice"])


def index_clusters_parent(spark, sf):
    return _clusters_of(_parent_table(spark, sf), CLUSTERS["pcn"])


QUERIES: dict[str, Query] = {
    "scan_project_rename": scan_project_rename,
    "csv_roundtrip": csv_roundtrip,
    "csv_quarantine": csv_quarantine,
    "multi_file_union": multi_file_union,
    "extracts_union": extracts_union,
    "age_union": age_union,
    "snapshot_refresh": snapshot_refresh,
    "snapshot_unit": snapshot_unit,
    "active_filter": active_filter,
    "prefix_filter_dq": prefix_filter_dq,
    "not_in_keep_null": not_in_keep_null,
    "pattern_select": pattern_select,
    "reorder_rename_keep": reorder_rename_keep,
    "registration_base": registration_base,
    "registration_base_sheets": registration_base_sheets,
    "org_index": org_index,
    "parent_index": parent_index,
    "parent_index_sheets": parent_index_sheets,
    "null_safe_join": null_safe_join,
    "feature_join_guard": feature_join_guard,
    "multi_left_join_unpivot": multi_left_join_unpivot,
    "indicator_sheets": indicator_sheets,
    "sum_ignore_null": sum_ignore_null,
    "sum_poison_null": sum_poison_null,
    "apportion_org": apportion_org,
    "apportion_parent": apportion_parent,
    "density_apportion": density_apportion,
    "density_attributes": density_attributes,
    "area_remap_share": area_remap_share,
    "ethnicity_apportion": ethnicity_apportion,
    "deprivation_apportion": deprivation_apportion,
    "age_quartiles_org": age_quartiles_org,
    "age_quartiles_parent": age_quartiles_parent,
    "price_quantiles_ranked": price_quantiles_ranked,
    "prevalence_org": prevalence_org,
    "prevalence_parent": prevalence_parent,
    "achievement_org": achievement_org,
    "achievement_parent": achievement_parent,
    "workforce_pivot_fill": workforce_pivot_fill,
    "workforce_parent": workforce_parent,
    "income_rowwise": income_rowwise,
    "standardise": standardise_features,
    "pairwise_distance": pairwise_distance,
    "nearest_10": nearest_10,
    "farthest_10": farthest_10,
    "nearest_10_block": nearest_10_block,
    "nearest_10_balls": nearest_10_balls,
    "farthest_10_balls": farthest_10_balls,
    "neighbours_refreshed": neighbours_refreshed,
    "neighbours_customer": neighbours_customer,
    "kmeans_assign_fixed": kmeans_assign_fixed,
    "kmeans_best_of": kmeans_best_of,
    "kmeans_bounded": kmeans_bounded,
    "total_ss": total_ss,
    "wss_sweep": wss_sweep,
    "silhouette_labels": silhouette_labels,
    "silhouette_sweep": silhouette_sweep,
    "silhouette_sampled": silhouette_sampled,
    "silhouette_bounds": silhouette_bounds,
    "map_layer": map_layer_rows,
    "map_layer_of_cluster": map_layer_of_cluster,
    "full_index": full_index,
    "full_index_parent": full_index_parent,
    "index_neighbours": index_neighbours,
    "index_neighbours_parent": index_neighbours_parent,
    "index_clusters": index_clusters,
    "index_clusters_parent": index_clusters_parent,
}
