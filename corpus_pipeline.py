"""The corpus pipeline: quality rules, near-duplicates, benchmark
decontamination, personal data, SentencePiece encoding.

Each stage works on all documents that its predecessor kept.  The filtering stages
decide for each row; a repeated or null doc_id shares nothing (see each operator).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from triad.llm.leaks import drop_leaks
from triad.llm.near import keep_one
from triad.llm.pii import redact
from triad.llm.quality import keep_good
from triad.llm.segment import encoded
from triad.session import stage_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group (five-word shingles, 0.8) stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item has leaked go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked."""
    return redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations: doc_id, sample, ids and their scores."""
    return encoded(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("encoding", encoding)]

#: Covariance iterations, tilings and sampled lattices are beyond SQL; the
#: stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = stage_dir(spark, f"corpus-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
