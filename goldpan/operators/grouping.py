"""Group counts, table profiles and label inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: distinct label counts that decide the task type
REGRESSION_ABOVE = 10  # more distinct labels than this: a continuous target
MULTICLASS_ABOVE = 2


def nonnull_counts(df: DataFrame, key: str) -> DataFrame:
    """Per key, the number of non-null values of every other column; rows without key are left out."""
    others = [c for c in df.columns if c != key]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.count(c).alias(c) for c in others])


def profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, non-null count.  One pass over the data."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col(c).alias("non_null"),
                 F.col("_rows").alias("row_count"))
        for c, t in df.dtypes
    ]
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def task_type(n_distinct: int) -> str:
    if n_distinct > REGRESSION_ABOVE:
        return "regression"
    return "multiclass" if n_distinct > MULTICLASS_ABOVE else "classification"


def detect_task(df: DataFrame, label: str) -> DataFrame:
    """Task type of a label column with its number of distinct non-null values, counted after a distributed distinct."""
    counted = df.where(F.col(label).isNotNull()).select(label).distinct().agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.col("n").alias("n_labels"),
        F.when(F.col("n") > REGRESSION_ABOVE, "regression")
        .when(F.col("n") > MULTICLASS_ABOVE, "multiclass")
        .otherwise("classification")
        .alias("task"),
    )
