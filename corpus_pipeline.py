"""Documents to shards: language ID, near-duplicates, decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it works on
all rows that the stage before kept.  All but the last return the columns of
``documents``, whatever these are; the last adds the shard.  ``run`` writes each
stage's result to the shared folder and reads it again as the next one's input,
so a lost executor never sends work back past a stage.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from peerlens.llm.language_crf import in_known_language  # noqa: E402
from peerlens.llm.mixing import mixture  # noqa: E402
from peerlens.llm.ngram_join import one_of_each_group  # noqa: E402
from peerlens.llm.sharding import sharded  # noqa: E402
from peerlens.llm.spaced_seeds import without_leaks  # noqa: E402
from peerlens.llm.store import stored  # noqa: E402

#: A document stays when its best language has at least this share of its words.
LEAST_LANGUAGE_SHARE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are mostly of one known language; null texts and texts without letters go."""
    return in_known_language(docs, LEAST_LANGUAGE_SHARE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return one_of_each_group(docs, words=5, percent=75)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixture(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard each goes to."""
    return sharded(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: SQL cannot express the first stage; the tests compare with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
