"""The operators over whole tables, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm.ann import nearest_neighbours
from gaugeflow.llm.audit import filter_audit
from gaugeflow.llm.audit import oracle as audit_oracle
from gaugeflow.llm.bpe import round_trip_digest
from gaugeflow.llm.chat import chat_digest
from gaugeflow.llm.chat import oracle as chat_oracle
from gaugeflow.llm.jaccard import jaccard_groups
from gaugeflow.llm.language import identify
from gaugeflow.llm.licenses import document_paths, oracle, scan_licences
from gaugeflow.llm.packing import best_fit_packing
from gaugeflow.llm.pii import personal_data_digest
from gaugeflow.llm.quality import classify
from gaugeflow.llm.repair import repair_digest
from gaugeflow.llm.rules import judge
from gaugeflow.llm.token_files import token_files_digest

BYTE_VOCABULARY = path("byte_bpe_50k.json")
WORD_VOCABULARY = path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(document_paths(_table(spark, sf_dir, "documents")))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files_digest(_table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(_table(spark, sf_dir, "documents"))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digest(_table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(_table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digest(_table(spark, sf_dir, "conversations"))


def op12_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digest(_table(spark, sf_dir, "conversations"), BYTE_VOCABULARY)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_nearest_neighbours,
        op2_license_scan,
        op3_jaccard_join,
        op4_token_files,
        op5_quality_classifier,
        op6_personal_data,
        op7_bpe_round_trip,
        op8_quality_rules,
        op9_best_fit_packing,
        op10_language_id,
        op11_conversation_repair,
        op12_chat_tree,
        op13_filter_audit,
    )
}

ORACLES: dict[str, str] = {"op2_license_scan": oracle(), "op12_chat_tree": chat_oracle(), "op13_filter_audit": audit_oracle()}
