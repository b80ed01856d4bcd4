"""A training corpus from raw documents: five stages, each written and read again."""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rdfweave.llm import common, minhash, packing, pii, tiling, toxicity  # noqa: E402


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model (operator 10) does not reject."""
    return toxicity.without_toxic(spark, docs, common.table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 7), on five-word shingles."""
    return minhash.one_of_each(spark, docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates (operator 6)."""
    return tiling.without_leaks(spark, docs, common.table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced (operator 2)."""
    return pii.without_personal_data(spark, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 1,024 tokens (operator 8), ids included."""
    return packing.pack_documents(docs, ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: The first stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; every stage is staged in the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{common.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
