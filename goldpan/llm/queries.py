"""Queries of the text operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm import ann, decontaminate, divergence, language, licenses, mixing, neardup, pages, spelling, substrings, tokens, topk, toxicity
from goldpan.queries.registry import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def crc_fold(column: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; null ids belong to no fold."""
    return F.crc32(F.col(column).cast("string")) % folds


@query("op1_toxicity")
def toxicity_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(crc_fold("doc_id", 5) != 0)
    scored = toxicity.score_documents(docs, toxicity.fit_toxicity(docs, labels))
    return scored.select("doc_id", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op2_decontaminate")
def leaks_in_documents(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_mix_sources", mixing.mix_sql())
def mix_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


@query("op4_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_near_duplicates")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicate_classes(table(spark, folder, "documents"))


@query("op6_main_text")
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(table(spark, folder, "pages"))


@query("op7_top_k", topk.TOP_K_SQL)
def top_k_of_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query("op8_language")
def language_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(False))
    model = language.fit_language_model(docs.where(~held_out).select("doc_id", "text", "lang"))
    scored = docs.select("doc_id", held_out.alias("held_out"), language.predict_language(docs, model).alias("p"))
    return scored.select("doc_id", "held_out", "p.lang_pred", "p.score")


@query("op9_license_scan")
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query("op10_repeated_passages", substrings.REPEATED_SQL)
def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeated_passages(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op11_spelling_variants", spelling.VARIANTS_SQL)
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(table(spark, folder, "documents"))


@query("op12_nearest_neighbours")
def neighbours_of_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query("op13_source_divergence", divergence.DIVERGENCE_SQL)
def divergence_of_sources(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(table(spark, folder, "documents"))
