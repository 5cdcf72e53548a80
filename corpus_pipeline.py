"""Corpus pipeline: documents through five operators, each on all that its predecessor kept.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents; sharding adds the shard and
slot of each row. run() applies them to documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goldweave.llm import classifier, decontaminate, mixing, sharding, simhash
from goldweave.llm.common import table, written

#: The mix takes three quarters of the words, none twice: sources weigh 5, 2, 1 in turn as in the mixing query.
MIX_PERCENT, MIX_PASSES = 75, 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return classifier.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or near texts (five-word shingles, similarity 0.8 or more)."""
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes."""
    return mixing.taken(docs, share_percent=MIX_PERCENT, passes=MIX_PASSES)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its size, text_crc32, shard and slot."""
    return sharding.sharded(docs)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

#: The classifier is learned, so SQL can't express the result; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
