"""The registered queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language_model, near_dedup, packing, quality, sale_enrichment, secrets, site_tree, spelling, token_counts, topk, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("evidence")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.extract(table(spark, sf_dir, "pages"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"), spark).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op13_sale_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale_enrichment.enrich(table(spark, sf_dir, "sales"), table(spark, sf_dir, "client_changes"))


QUERIES: dict[str, Query] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_language_model": op2_language_model,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_main_text": op8_main_text,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_warc": op10_warc,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_counts": op12_token_counts,
    "op13_sale_enrichment": op13_sale_enrichment,
}
