"""The corpus pipeline: documents that are good, apart, clean of test items, and packed.

A document is a row; a null text is an empty one.  Every stage reads whole
texts, however long, and all but the last return the columns of ``documents``,
and any extra ones, as they are.  Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnfold.llm import cotraining, decontaminate, packing, similar
from tarnfold.llm._shared import workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject.

    Null and empty texts and null metadata are scored by what they are; repeated
    rows go or stay alike; a score of exactly the threshold stays.  Without
    labels of both kinds all documents stay.
    """
    return cotraining.keep_good(docs, cotraining.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 0.8 or more of their five-word shingles: that of the smallest id.

    Null and empty texts are copies of each other.  A repeated id with an unlike
    text is another document; a null id comes after all others; of repeated rows
    one stays.
    """
    return similar.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Null and empty texts contain nothing and stay, and null and empty items are
    in nothing; repeated rows go or stay alike.
    """
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes.

    An empty or null text has its end as its only token; a null id is packed as
    any other; a null source conflicts with nothing; repeated rows are packed each.
    """
    return packing.pack(docs)


STAGES = [("quality", quality), ("simhash", dedup), ("decontamination", clean), ("packing", pack)]

#: No SQL trains a classifier or packs bins; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to shared storage and read again."""
    path = workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return docs
