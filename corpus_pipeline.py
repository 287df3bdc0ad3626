"""A training-data pipeline over ``documents``: quality, near-duplicates, benchmark leaks, mix, shards.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return
the columns of ``documents``. Stages are written to the shared folder and read again in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import decontaminate, mixing, quality, sharding, simhash
from dayledger.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of ``docs``, scores 0.5 or more."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 or more of their 5-word shingles in common)."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, exact or edited."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (at most twice)."""
    return mixing.apply_mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every document of the mix."""
    return sharding.shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing to target weights", source_mixing),
    ("sharding", shards),
]

#: A learned classifier decides the first stage, which SQL cannot express; tests compare each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
