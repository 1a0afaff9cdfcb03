"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from catalogue import queries as q
from catalogue.views import CONDITIONS, view
from peerlens.operators import neighbours
from peerlens.operators.blocks import plan_blocks, to_block_pairs
from peerlens.operators.standardise import as_vectors, standardise
from peerlens.plans import index as index_plan
from peerlens.plans import organisations as orgs
from peerlens.plans.names import similarity_features
from peerlens.sources.staging import shared_root, stage

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    stored = stage(view(spark, SF, "v_prac"), "plan")
    text = plan(orgs.active_practices(stored).select("prac_code"))
    assert "IsNull(close_date), EqualTo(status_code,A), EqualTo(presc_code,4)" in text.replace("IsNotNull(status_code), IsNotNull(presc_code), ", "")
    assert "ReadSchema: struct<prac_code:string,close_date:string,status_code:string,presc_code:int>" in text
    areas = stage(view(spark, SF, "v_reg"), "plan")
    assert "StringStartsWith(lsoa11cd,E)" in plan(areas.filter(orgs.is_english("lsoa11cd")))


# These run fits before they have a plan, which is then that of kmeans_assign_fixed or silhouette_labels.
FITTED = {"kmeans_best_of", "wss_sweep", "silhouette_sweep", "index_clusters", "index_clusters_parent"}


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - FITTED))
def test_no_cross_or_nested_loop_joins(spark, no_broadcast, name):
    text = plan(q.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_one_join_of_weights_to_areas_serves_both_levels(spark, no_broadcast):
    s = q.sources(spark, SF)
    sums = index_plan.stored_area_sums(s)
    for table in (index_plan.practice_table(s, sums), index_plan.parent_table(s, sums)):
        assert "geo_code" not in plan(table)


def test_area_sums_combine_before_their_shuffle(spark, no_broadcast):
    s = q.sources(spark, SF)
    base = stage(index_plan.base(s), "registrations")
    text = plan(index_plan.area_sums(s, base))
    tree = text[: text.index("\n\n(1)")]
    joined = tree.index("Generate")
    assert tree[:joined].count("HashAggregate") >= 2  # map side and final
    assert "BatchEvalPython" not in text


def test_block_pairs_shuffle_once_and_keep_their_partitions(spark):
    vectors = spark.range(4000).selectExpr("id AS key", "array(double(id)) AS vec")
    blocks = plan_blocks(4000, 1, 8)
    pairs = to_block_pairs(vectors, blocks)
    grouped = pairs.groupBy("pair").applyInArrow(lambda t: t, pairs.schema)
    assert len(re.findall(r"\n\(\d+\) Exchange", plan(grouped))) == 1
    sizes = pairs.groupBy("pair").count().collect()
    assert len(sizes) == blocks.pairs
    assert sum(r["count"] for r in sizes) == 4000 * blocks.blocks
    assert pairs.rdd.getNumPartitions() == blocks.tasks


def test_top_k_is_limited_per_group(spark):
    found = neighbours.nearest_from_pairs(spark.createDataFrame([("a", "b", 1.0)], "orig string, dest string, distance double"))
    assert "WindowGroupLimit" in plan(found)


def test_statistics_are_planned_once_for_all_features(spark):
    features = similarity_features(CONDITIONS)
    df = spark.createDataFrame([("a", *[1.0] * len(features))], "k string, " + ", ".join(f"{f} double" for f in features))
    text = plan(as_vectors(standardise(df, ["k"], features), "k", features))
    assert len(re.findall(r"Subquery:\d+", text)) <= 1


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = shared_root(spark)
    assert root == configured.rstrip("/") if configured else root


def test_chained_tables_are_not_broadcast(spark):
    """Tables as long as their base look small on disk; six of them broadcast at once fill the driver."""
    from peerlens.operators.joins import chain_left

    base, one, two = (stage(spark.range(1000).select(F.col("id").alias("key"), F.col("id").alias(n)), "plan") for n in "abc")
    joined = chain_left(base, [one, two], "key")
    assert "Broadcast" not in plan(joined) and plan(joined).count("SortMergeJoin LeftOuter") >= 2
    assert joined.count() == 1000
