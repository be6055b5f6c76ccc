"""Stages that turn the raw documents into tokenised training text.

Each stage works on everything its predecessor kept; all but the last return the
columns of the documents. Documents are written between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelrisk.llm import bpe, decontamination, jaccard, pii, quality
from panelrisk.llm.queries import PII_KEY, vocabulary
from panelrisk.llm.sampling import remainder
from panelrisk.sources.tables import parquet_table
from panelrisk.storage import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = parquet_table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, remainder(F.col("doc_id"), 5) != 0)
    return quality.score_documents(docs, model).where("predicted = 1").select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the smallest id stays."""
    return jaccard.keep_one(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark windows leave the text."""
    return decontamination.remove_windows(docs, parquet_table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates."""
    return pii.replace_values(docs, PII_KEY).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text with the digests of ids and decoded text."""
    return bpe.encode_documents(docs, vocabulary(), with_ids=True)


STAGES = [
    ("quality", keep_good),
    ("near duplicates", keep_one_of_each_group),
    ("decontamination", decontaminate),
    ("personal data", replace_personal_data),
    ("tokens", encode),
]
ORACLE_SQL = None  # no stage but the second can be put in SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
