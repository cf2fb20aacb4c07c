"""A cleaning and mixing pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fieldmill.llm.decontamination import drop_contaminated
from fieldmill.llm.mixing import mix
from fieldmill.llm.near_duplicates import keep_one_of_each
from fieldmill.llm.repeats import drop_repeats
from fieldmill.llm.tables import shared_dir, table
from fieldmill.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under 0.3."""
    labels = table(spark, sf_dir, "labels")
    return drop_toxic(docs, table(spark, sf_dir, "documents"), labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id."""
    return keep_one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words that stand earlier already."""
    return drop_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their block, its place in the mix, and how often it comes."""
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: a trained classifier and alignments are beyond SQL; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, written under the shared checkpoint folder."""
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
