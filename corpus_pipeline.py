"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. ``run``
writes each stage's rows as Parquet to the shared folder and reads them as the next one's ``docs``, so a lost executor costs
one stage's work at most. All return the columns of ``documents``; the mix has up to 3 copies of a document,
each with the words that are taken that often; the last stage adds the shard columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import decontaminate, mixing, near_dedup, quality_rules, sharding
from shoplens.llm.common import scratch
from shoplens.runtime import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the rules."""
    return quality_rules.filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each class."""
    return near_dedup.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark passage."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources come near their target weights."""
    return mixing.mix_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the rows out to shards of nearly equal bytes."""
    return sharding.shard(docs)


STAGES = [("quality rules", quality), ("near dedup", near_duplicates), ("decontamination", benchmark_leaks),
          ("mixing", mix), ("sharding", shards)]

#: The hashes and random draws of the stages have no equal in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, "corpus-pipeline")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        with scratch(spark):  # a stage's own intermediates go once its rows are written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
