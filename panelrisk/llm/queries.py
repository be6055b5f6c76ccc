"""Registered queries of the operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelrisk.llm import (
    bpe, decontamination, jaccard, language, neighbours, pii, quality, repeats, scoring, sharding, spelling, urls, whitening,
)
from panelrisk.llm.oracle import ORACLE_SQL  # noqa: F401
from panelrisk.llm.sampling import remainder
from panelrisk.sources.tables import parquet_table


PII_KEY = "key of the registered query; a real run brings its own secret"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(parquet_table(spark, folder, "documents"), vocabulary())


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = parquet_table(spark, folder, "documents")
    usable = remainder(F.col("doc_id"), 5) != 0
    model = quality.train(docs, parquet_table(spark, folder, "labels"), usable)
    scored = quality.score_documents(docs.select("doc_id", "text"), model)
    return scored.select(
        "row.doc_id", (remainder(F.col("row.doc_id"), 5) == 0).alias("held_out"), "score", "predicted"
    )


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(parquet_table(spark, folder, "documents"), shards=40)


def op4_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(parquet_table(spark, folder, "documents"))


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(parquet_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked_groups(parquet_table(spark, folder, "documents"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = parquet_table(spark, folder, "documents")
    model = language.train(docs, remainder(F.col("doc_id"), 5) != 0)
    return language.identify(docs, model).withColumn("held_out", remainder(F.col("doc_id"), 5) == 0)


def op8_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = parquet_table(spark, folder, "documents")
    return scoring.score_documents(docs, remainder(F.col("doc_id"), 5) == 1)


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = parquet_table(spark, folder, "documents")
    found = decontamination.locate_windows(docs, parquet_table(spark, folder, "benchmark"))
    return decontamination.digest(found)


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = parquet_table(spark, folder, "documents").select("doc_id", "text")
    return pii.replace_values(docs, PII_KEY)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(parquet_table(spark, folder, "embeddings"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(parquet_table(spark, folder, "documents"))


def op13_urls(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(parquet_table(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    "op1_bpe": op1_bpe, "op2_quality": op2_quality, "op3_sharding": op3_sharding, "op4_repeats": op4_repeats,
    "op5_neighbours": op5_neighbours, "op6_jaccard": op6_jaccard, "op7_language": op7_language,
    "op8_scoring": op8_scoring, "op9_decontamination": op9_decontamination, "op10_pii": op10_pii,
    "op11_whitening": op11_whitening, "op12_spelling": op12_spelling, "op13_urls": op13_urls,
}
