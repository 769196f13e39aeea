"""From metric rows to a ranked leaderboard.

Metric tables have one row per problem, model and run: a few thousand rows at most, whatever the size of the data
the models were trained on.  The windows per problem below run on such tables only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: metric weights of the overall score per problem type
CLASSIFICATION_WEIGHTS = {"F1": 0.40, "Accuracy": 0.25, "Precision": 0.15, "Recall": 0.10, "ROC-AUC": 0.10}
REGRESSION_WEIGHTS = {"MAE": 0.40, "MSE": 0.30, "R²": 0.30}
TIME_SERIES_WEIGHTS = {"MAE": 0.50, "MSE": 0.30, "R²": 0.20}

# fixed values: metric name in a configuration -> column of the metric table, and whether lower is better
METRIC_COLUMNS = {
    "Accuracy": ("test_accuracy", False),
    "F1": ("test_f1", False),
    "Precision": ("test_precision", False),
    "Recall": ("test_recall", False),
    "ROC-AUC": ("test_roc_auc", False),
    "MAE": ("test_mae", True),
    "MSE": ("test_mse", True),
    "RMSE": ("test_rmse", True),
    "R²": ("test_r2", False),
}

# fixed values: thresholds and penalties
OVERFIT_ABOVE = 0.98  # every normalized metric above this: flagged
OVERFIT_FACTOR = 0.5  # what a flagged classifier keeps of its score
PENALTY = 0.15  # what an overfitted regressor loses
PENALTY_MAE_RATIO = 0.5  # train MAE below this share of the test MAE: overfitted


def normalize(df: DataFrame, metrics: Sequence[str], problem: str = "problem") -> DataFrame:
    """Min-max scaled copies ``norm_<metric>`` over all rows of a problem; a constant metric becomes 0."""
    rows = Window.partitionBy(problem)
    low = {m: F.min(m).over(rows) for m in metrics}
    width = {m: F.max(m).over(rows) - low[m] for m in metrics}
    return df.withColumns(
        {f"norm_{m}": F.when(width[m] == 0, 0.0).otherwise((F.col(m) - low[m]) / width[m]) for m in metrics})


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Weighted sum of normalized metrics, each turned so that higher is better."""
    unknown = sorted(set(weights) - set(METRIC_COLUMNS))
    if unknown:
        raise ValueError(f"unknown metrics {unknown}; known: {sorted(METRIC_COLUMNS)}")
    total = F.lit(0.0)
    for name, weight in weights.items():
        column, lower_is_better = METRIC_COLUMNS[name]
        value = F.col(f"norm_{column}")
        total = total + F.lit(float(weight)) * (1 - value if lower_is_better else value)
    return total


def metric_columns(weights: Mapping[str, float]) -> list[str]:
    return [METRIC_COLUMNS[name][0] for name in weights]


def flag_overfit(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    condition = F.lit(True)
    for m in metrics:
        condition = condition & (F.col(f"norm_{m}") > OVERFIT_ABOVE)
    return df.withColumn("overfit_flag", condition)


def score_classification(df: DataFrame, weights: Mapping[str, float] = CLASSIFICATION_WEIGHTS) -> DataFrame:
    metrics = metric_columns(weights)
    flagged = flag_overfit(normalize(df, metrics), metrics)
    score = weighted_score(weights)
    return flagged.withColumn("golden_score", F.when(F.col("overfit_flag"), score * OVERFIT_FACTOR).otherwise(score))


def score_regression(df: DataFrame, weights: Mapping[str, float] = REGRESSION_WEIGHTS) -> DataFrame:
    return normalize(df, metric_columns(weights)).withColumn("golden_score", weighted_score(weights))


def average_runs(df: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ("problem", "model")) -> DataFrame:
    """Mean of every metric over the runs of a model."""
    return df.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in metrics])


def score_regression_averaged(df: DataFrame) -> DataFrame:
    """Averaged form: RMSE instead of MSE, and a penalty where the training error is far below the test error."""
    metrics = ["train_mae", "test_mae", "test_mse", "test_rmse", "test_r2"]
    averaged = average_runs(df, metrics)
    weights = {"MAE": 0.40, "RMSE": 0.30, "R²": 0.30}
    overfitted = F.col("train_mae") < PENALTY_MAE_RATIO * F.col("test_mae")
    return (
        normalize(averaged, metric_columns(weights))
        .withColumn("overfit_penalty", F.when(overfitted, PENALTY).otherwise(0.0))
        .withColumn("golden_score", weighted_score(weights) - F.col("overfit_penalty"))
    )


def leaderboard(df: DataFrame, score: str = "golden_score", problem: str = "problem") -> DataFrame:
    """Rows of every problem ranked by score; equal scores are ordered by model and run."""
    ties = [c for c in ("model", "run") if c in df.columns]
    order = Window.partitionBy(problem).orderBy(F.desc(score), *ties)
    return df.withColumn("rank", F.row_number().over(order)).orderBy(problem, "rank")
