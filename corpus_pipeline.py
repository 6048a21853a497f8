"""The corpus pipeline: quality rules, near-deduplication, personal data, mixing and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cinderframe.llm import mixing, near_dedup, packing, pii, quality_rules
from cinderframe.llm.common import shared_dir
from cinderframe.llm.registry import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base nor a rule rejects."""
    return quality_rules.keep_good(docs).select(COLUMNS)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.keep_one(docs).select(COLUMNS)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind."""
    return pii.redact(docs).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_rows(docs).select(COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality_rules", rules), ("near_dedup", dedup), ("pii", private), ("mixing", mixture), ("packing", sequences)]

#: SQL expresses neither the sketches nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
