from collections import Counter

import duckdb

import __spark_entry__ as registry
import corpus_pipeline
from peerlens.llm import oracles
from peerlens.llm.language_crf import language_of
from tests.llm.test_ngram_join import plain as plain_groups
from tests.llm.test_spaced_seeds import plain as plain_leaks


def test_run_agrees_with_plain_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    languages = language_of(docs).collect()
    kept = {r.doc_id for r in languages if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_LANGUAGE_SHARE}
    groups = plain_groups([(k, rows[k].text) for k in sorted(kept)])
    kept = {k for k, _, component, _ in groups if k == component}
    items = [r.text for r in sorted(spark.read.parquet(f"{small}/benchmark.parquet").collect())]
    kept -= {k for k, _ in plain_leaks([(k, rows[k].text) for k in kept], items)}

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet' WHERE doc_id IN {tuple(kept)}")
    want = Counter({r[0]: r[4] for r in duck.execute(oracles.MIX).fetchall() if r[1]})
    out = corpus_pipeline.run(spark, small)
    assert out.columns == [*docs.columns, "shard"]
    result = out.collect()
    assert Counter(r.doc_id for r in result) == +want
    assert all(r.text == rows[r.doc_id].text and 0 <= r.shard < 8 for r in result)


def test_stages_keep_the_columns_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(30)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small).columns == docs.columns, name
        assert stage(spark, empty, small).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, empty, small).collect() == []


def test_all_queries_are_registered(spark):
    names = list(registry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
