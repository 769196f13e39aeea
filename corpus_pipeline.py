"""Preparing a corpus for training: five stages, each written as Parquet and read again as the documents of the next.

language ID -> near duplicates -> repeated passages -> benchmark leaks -> source mix.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm import decontaminate, language, mixing, neardup, substrings
from goldpan.llm.queries import crc_fold
from goldpan.llm.shared import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_CONFIDENCE = 0.5
BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000


def _small_batches(spark: SparkSession) -> None:
    """Rows hold whole texts, so fewer of them go to a Python worker at a time; memory matters here, results do not depend on it."""
    if int(spark.conf.get(BATCH_KEY)) > BATCH_ROWS:
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language can be told: neither undetermined nor of less than LEAST_CONFIDENCE.

    Null, empty and letter-free texts go.  If no row has a language to learn from, rows with letters stay.
    """
    _small_batches(spark)
    held_out = F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(False))
    model = language.fit_language_model(docs.where(~held_out).select("doc_id", "text", "lang"))
    if model is None:
        return docs.select(COLUMNS).where(F.regexp_like("text", F.lit(r"\p{L}")))
    scored = docs.select(*COLUMNS, language.predict_language(docs, model).alias("_p"))
    return scored.where((F.col("_p.lang_pred") != language.UNDETERMINED) & (F.col("_p.score") >= LEAST_CONFIDENCE)).select(COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every class of near duplicates: the text with the smallest id, of rows that repeat it one.

    Rows that share an id but not their words are different texts; each is kept or goes with its own class.  Rows without an id, and rows
    without words, stay: they are in no class with others.
    """
    _small_batches(spark)
    firsts = neardup.class_firsts(docs.select("doc_id", "text").where(F.col("doc_id").isNotNull()))
    marked = docs.select(*COLUMNS, neardup.content_digest("text").alias("_content"))
    alone = F.col("doc_id").isNull() | F.col("_content").isNull()
    names = firsts.select(F.col("doc_id").alias("_first"), F.col("content").alias("_same"), F.lit(True).alias("_is_first"))
    named = marked.join(names, (F.col("doc_id") == F.col("_first")) & (F.col("_content") == F.col("_same")), "left")
    # rows that repeat id and words are one; those in no class are told apart
    kept = named.where(alone | F.col("_is_first")).withColumn("_own", F.when(alone, F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    return kept.dropDuplicates(["doc_id", "_content", "_own"]).select(COLUMNS)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows that an earlier document has; a text that loses nothing keeps its layout, one that loses all goes."""
    _small_batches(spark)
    cut = substrings.remove_repeated_passages(docs, carry=COLUMNS[1:])
    whole = F.col("n_removed") == 0
    return cut.where(whole | (F.col("kept_text") != "")).select(
        "doc_id", F.when(whole, F.col("text")).otherwise(F.col("kept_text")).alias("text"), "lang", "source",
        F.when(whole, F.col("n_chars")).otherwise(F.char_length("kept_text").cast("long")).alias("n_chars"))


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    _small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_leaks(docs, benchmark, carry=COLUMNS[1:]).where(~F.col("contaminated")).select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with the number of times it is to be read (``repeats``) so that the sources meet their weights."""
    return mixing.mix_sources(docs, carry=COLUMNS[1:])


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identified),
    ("near_duplicates", without_near_duplicates),
    ("repeated_passages", without_repeated_passages),
    ("benchmark_leaks", without_leaks),
    ("source_mix", mixed),
]

# Language scores and near duplicates cannot be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
