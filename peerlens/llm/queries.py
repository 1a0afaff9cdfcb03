"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from peerlens.llm import oracles
from peerlens.llm.importance_sample import importance_sample
from peerlens.llm.language_crf import language_of
from peerlens.llm.license_scan import license_scan
from peerlens.llm.mixing import mix
from peerlens.llm.ngram_join import ngram_groups
from peerlens.llm.passage_quality import quality_scores
from peerlens.llm.personal_data import personal_data
from peerlens.llm.sharding import shard_table
from peerlens.llm.spaced_seeds import benchmark_leaks, leaked_documents
from peerlens.llm.suffix_repeats import repeated_passages
from peerlens.llm.token_alignment import token_alignment
from peerlens.llm.vector_file import top_k
from peerlens.llm.warc import derive, described, responses

#: Where the public vocabulary files lie.
TOKENIZERS = "/opt/tokenizers"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(oracle: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if oracle:
            ORACLES[run.__name__] = oracle
        return run

    return register


@query(oracles.NGRAM_GROUPS)
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return ngram_groups(table(spark, sf_dir, "documents"), words=5, percent=75)


@query()
def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those that are not held out."""
    return language_of(table(spark, sf_dir, "documents"))


@query()
def op7_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark texts, and which."""
    return leaked_documents(benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query(oracles.MIX)
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of all sources takes."""
    return mix(table(spark, sf_dir, "documents")).drop("row")


@query()
def op6_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document."""
    return shard_table(table(spark, sf_dir, "documents"))


@query(oracles.TOP_K)
def op8_vector_file_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every fiftieth."""
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


@query()
def op1_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels of those that are not held out."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_suffix_array_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of 50 words or more that all documents have in common with others."""
    return repeated_passages(table(spark, sf_dir, "documents"), length=50)


@query()
def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of all pages, by their fields and digests."""
    return described(derive(responses(table(spark, sf_dir, "pages"))))


@query(oracles.LICENSE_SCAN)
def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that whole documents, or whole lines of them, are."""
    return license_scan(table(spark, sf_dir, "documents"))


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents under two public tokenizers, aligned by bytes."""
    byte_bpe, piece_bpe = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
    return token_alignment(table(spark, sf_dir, "documents"), byte_bpe, piece_bpe)


@query(oracles.IMPORTANCE)
def op12_head_tail_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents, drawn by their likeness to the benchmark."""
    return importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op13_contextual_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, by rules and by the contexts that it stands in."""
    return personal_data(table(spark, sf_dir, "documents"))
