import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from goldpan.evaluation import metrics, scoring


def labeled(spark, rows):
    return spark.createDataFrame([("m", 0, float(y), float(p), s) for y, p, s in rows], "model string, run int, y double, yhat double, score double")


BY = ["model", "run"]


def test_class_without_prediction_counts_as_zero(spark):
    out = metrics.classification_metrics(labeled(spark, [(0, 0, 0.1), (0, 0, 0.2), (1, 0, 0.3), (2, 0, 0.3)]), BY).first()
    # class 0: precision 2/4, recall 1; classes 1 and 2: all 0
    assert out["test_precision"] == pytest.approx(0.25)
    assert out["test_recall"] == out["test_accuracy"] == pytest.approx(0.5)
    assert out["test_f1"] == pytest.approx(0.5 * (2 * 0.5 / 1.5))


def test_auc_gives_half_credit_for_ties_and_mirrors(spark):
    rows = [(0, 0, 0.5), (1, 1, 0.5), (1, 1, 0.9), (0, 0, 0.1), (0, 1, 0.9)]
    auc = metrics.roc_auc(labeled(spark, rows), BY).first()["test_roc_auc"]
    # pairs (positive, negative): 0.5 vs 0.5 half, 0.1 win, 0.9 loss; 0.9 vs 0.5 win, 0.1 win, 0.9 half
    assert auc == pytest.approx((0.5 + 1 + 0 + 1 + 1 + 0.5) / 6)
    mirrored = metrics.roc_auc(labeled(spark, [(y, p, -s) for y, p, s in rows]), BY).first()["test_roc_auc"]
    assert auc + mirrored == pytest.approx(1.0)


def test_auc_is_zero_without_scores(spark):
    out = metrics.classification_metrics(labeled(spark, [(0, 0, None), (1, 1, None)]), BY).first()
    assert out["test_roc_auc"] == 0 and out["auc_available"] is False


def test_metrics_agree_with_spark_ml(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 600)
    s = np.round(y * 0.3 + rng.random(600) * 0.7, 2)
    df = labeled(spark, [(int(a), int(b > 0.5), float(b)) for a, b in zip(y, s)])
    out = metrics.classification_metrics(df, BY).first()
    for name, column in (("accuracy", "test_accuracy"), ("f1", "test_f1"), ("weightedPrecision", "test_precision"), ("weightedRecall", "test_recall")):
        other = MulticlassClassificationEvaluator(labelCol="y", predictionCol="yhat", metricName=name).evaluate(df)
        assert out[column] == pytest.approx(other, abs=1e-9)
    other = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0).evaluate(df)
    assert out["test_roc_auc"] == pytest.approx(other, abs=1e-9)
    r = df.withColumn("yhat", F.col("score") * 2)
    got = metrics.regression_metrics(r, BY).first()
    for name in ("mae", "mse", "rmse", "r2"):
        assert got[f"test_{name}"] == pytest.approx(RegressionEvaluator(labelCol="y", predictionCol="yhat", metricName=name).evaluate(r), abs=1e-9)


CLASS = ["test_accuracy", "test_f1", "test_precision", "test_recall", "test_roc_auc"]


def results(spark, rows):
    return spark.createDataFrame([("classification", m, r, *v) for m, r, v in rows], "problem string, model string, run int, " + ", ".join(f"{c} double" for c in CLASS))


def test_constant_metric_normalizes_to_zero(spark):
    out = scoring.score_classification(results(spark, [("a", 0, [0.7] * 5), ("b", 0, [0.7] * 5)])).collect()
    assert all(r["golden_score"] == 0 and r["norm_test_f1"] == 0 and r["overfit_flag"] is False for r in out)


def test_best_in_everything_is_flagged_and_halved(spark):
    out = {r["model"]: r for r in scoring.score_classification(results(spark, [
        ("best", 0, [1.0] * 5), ("worst", 0, [0.5] * 5), ("middle", 0, [0.9, 0.8, 0.9, 0.9, 0.0])])).collect()}
    assert out["best"]["overfit_flag"] and out["best"]["golden_score"] == pytest.approx(0.5)
    assert out["middle"]["golden_score"] == pytest.approx(0.40 * 0.6 + 0.25 * 0.8 + 0.15 * 0.8 + 0.10 * 0.8)
    assert all(0 <= r["golden_score"] <= 1 for r in out.values())


def test_recorded_leaderboard_row_is_reproduced(spark):
    # a recorded row of normalized metrics and its score
    norm = {"accuracy": 0.9523809523809526, "f1": 0.9517684986475121, "precision": 0.9491546114875167, "recall": 0.9523809523809526, "roc_auc": 0.9990079365079365}
    row = spark.createDataFrame([tuple(norm.values())], ", ".join(f"norm_test_{k} double" for k in norm))
    assert row.select(scoring.weighted_score(scoring.CLASSIFICATION_WEIGHTS)).first()[0] == pytest.approx(0.9563147181662593, abs=1e-12)


def test_averaged_regression_score_and_penalty(spark):
    rows = [("regression", m, r, tr, te, mse, math.sqrt(mse), r2) for m, r, tr, te, mse, r2 in [
        ("good", 0, 0.9, 1.0, 1.0, 0.9), ("good", 1, 1.1, 1.2, 1.4, 0.8), ("memory", 0, 0.1, 2.0, 4.0, 0.4), ("memory", 1, 0.1, 2.0, 4.0, 0.4)]]
    df = spark.createDataFrame(rows, "problem string, model string, run int, train_mae double, test_mae double, test_mse double, test_rmse double, test_r2 double")
    out = {r["model"]: r for r in scoring.score_regression_averaged(df).collect()}
    assert out["good"]["golden_score"] == pytest.approx(1.0) and out["good"]["overfit_penalty"] == 0
    assert out["memory"]["golden_score"] == pytest.approx(-0.15)
    # the mean of the run errors, not the root of the mean squared error
    assert out["good"]["test_rmse"] == pytest.approx((1 + math.sqrt(1.4)) / 2)


def test_leaderboard_breaks_ties_by_name_and_ranks_per_problem(spark):
    df = spark.createDataFrame([("p", "b", 0, 0.5), ("p", "a", 1, 0.5), ("p", "c", 0, 0.9), ("q", "z", 0, 0.1)], "problem string, model string, run int, golden_score double")
    out = [(r["problem"], r["rank"], r["model"]) for r in scoring.leaderboard(df).collect()]
    assert out == [("p", 1, "c"), ("p", 2, "a"), ("p", 3, "b"), ("q", 1, "z")]


def test_unknown_weight_is_refused():
    with pytest.raises(ValueError, match="unknown metrics"):
        scoring.weighted_score({"Luck": 1.0})
