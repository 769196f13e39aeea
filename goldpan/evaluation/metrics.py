"""Metrics of predictions, one row per group (for example per model and run).

Input columns: the group columns, ``y`` (true), ``yhat`` (predicted) and for the ROC curve ``score``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.operators.ordering import running_totals


def confusion(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Row counts per true and predicted class: classes squared rows per group."""
    return df.groupBy(*groups, "y", "yhat").agg(F.count("*").alias("n"))


def _by_class(table: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Support, predicted count and hits of every class, from the confusion table."""
    sides = F.array(
        F.struct(F.col("y").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("yhat").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("hits")),
    )
    return table.select(*groups, F.explode(sides).alias("e")).groupBy(*groups, "e.cls").agg(
        *[F.sum(f"e.{c}").alias(c) for c in ("support", "predicted", "hits")])


def accuracy(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    return df.groupBy(*groups).agg(F.avg((F.col("y") == F.col("yhat")).cast("double")).alias("test_accuracy"))


def class_metrics(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1; an undefined ratio counts as 0."""
    per_class = _by_class(confusion(df, groups), groups)

    def ratio(a, b):
        return F.when(b == 0, 0.0).otherwise(a / b)

    precision = ratio(F.col("hits"), F.col("predicted"))
    recall = ratio(F.col("hits"), F.col("support"))
    rated = per_class.withColumns({"p": precision, "r": recall}).withColumn(
        "f", ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    total = F.sum("support")
    return rated.groupBy(*groups).agg(
        (F.sum("hits") / total).alias("test_accuracy"),
        (F.sum(F.col("support") * F.col("f")) / total).alias("test_f1"),
        (F.sum(F.col("support") * F.col("p")) / total).alias("test_precision"),
        (F.sum(F.col("support") * F.col("r")) / total).alias("test_recall"),
    )


def roc_auc(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Area under the ROC curve with half credit for ties, of the rows that have a score.

    Equal scores are counted first; the number of negatives below each score is a running total over ranges of
    scores, so no group is sorted in one task.  A group without one of the two classes, or with further ones, gets null.
    """
    scored = df.filter(F.col("score").isNotNull())
    positive = F.col("y") == 1
    distinct = scored.groupBy(*groups, "score").agg(
        F.count(F.when(positive, 1)).alias("pos"), F.count(F.when(~positive, 1)).alias("neg"),
        F.count(F.when(~F.col("y").isin(0, 1), 1)).alias("further"))
    below = running_totals(distinct, groups, ["score"], {"neg_upto": F.col("neg")})
    credit = F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)
    area = F.sum(credit) / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))
    return below.groupBy(*groups).agg(F.when(F.sum("further") == 0, area).alias("test_roc_auc"))


def classification_metrics(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """All five classification metrics; a model without scores has ROC-AUC 0 and ``auc_available`` false."""
    joined = class_metrics(df, groups).join(roc_auc(df, groups), list(groups), "left")
    return joined.withColumn("auc_available", F.col("test_roc_auc").isNotNull()).fillna({"test_roc_auc": 0.0})


def regression_metrics(df: DataFrame, groups: Sequence[str], prefix: str = "test_") -> DataFrame:
    """MAE, MSE, RMSE and R2 = 1 - SSE/SST around the mean of the rows, in one aggregation.

    Rows without a prediction count in none of them.  A constant target has R2 1 for a perfect prediction and 0 otherwise.
    """
    error = F.col("y") - F.col("yhat")
    sums = df.groupBy(*groups).agg(
        F.avg(F.abs(error)).alias(f"{prefix}mae"), F.avg(error * error).alias(f"{prefix}mse"),
        F.var_pop(F.when(error.isNotNull(), F.col("y"))).alias("_var"))
    mse = F.col(f"{prefix}mse")
    r2 = F.when(F.col("_var") != 0, 1 - mse / F.col("_var")).otherwise(F.when(mse == 0, 1.0).otherwise(0.0))
    return sums.withColumns({f"{prefix}rmse": F.sqrt(mse), f"{prefix}r2": r2}).drop("_var")
