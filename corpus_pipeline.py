"""A corpus made ready for training: language, quality, near duplicates, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm.jaccard import one_per_group
from gaugeflow.llm.language import accepted_documents
from gaugeflow.llm.packing import best_fit_packing
from gaugeflow.llm.pii import without_personal_data
from gaugeflow.llm.quality import good_documents
from gaugeflow.llm.queries import BYTE_VOCABULARY
from gaugeflow.session import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs, BYTE_VOCABULARY)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("personal_data", personal_data),
    ("best_fit_packing", packing),
]

#: Compression, a trained scorer and a tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
