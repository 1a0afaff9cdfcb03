"""Every registered query against its SQL twin on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as registry
from tools.check_oracles import TABLES, compare

SF = "/root/testdata/sf0.001"
# Of the optional subpackage, whose tests lie beside it.
OPTIONAL = set(registry.LLM_QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_a_twin_or_a_reason():
    assert set(registry.queries()) - set(registry.oracle_sql()) <= OPTIONAL
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql()) - OPTIONAL))
def test_query_equals_its_twin(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    result = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert compare(df.columns, [tuple(r) for r in df.collect()], columns, result.fetchall()) == "ok"


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0


def test_same_answer_under_another_partitioning(spark):
    names = ["full_index_parent", "neighbours_customer", "kmeans_assign_fixed", "apportion_parent"]

    def answers():
        return {n: sorted(map(str, registry.queries()[n](spark, SF).collect())) for n in names}

    before = answers()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert answers() == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
