"""Cases outside the tables of the registered queries."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from goldpan.evaluation import harness, metrics
from goldpan.models import classifiers
from goldpan.operators import features, grouping, split


def test_ridge_tells_three_classes_apart(spark):
    df = spark.range(90).select(F.col("id"), (F.col("id") % 3).cast("double").alias("y"))
    df = df.withColumns({f"x{k}": (F.col("y") == k).cast("double") * 5 + F.col("id") % 2 for k in range(3)})
    rows = VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(df)
    assert classifiers.ridge()(rows)(rows).where("y != yhat").count() == 0


def test_onehot_keeps_values_that_differ_by_case_and_counts_nulls(spark):
    df = spark.createDataFrame([("AIR",)] * 4 + [("air",)] * 4 + [(None,)] * 2 + [("x",)], "v string")
    coded = features.onehot_minimum_fraction(df, "v", 0.2)
    flags = [c for c in coded.columns if c != "v"]
    assert len(flags) == 3
    assert coded.select(sum(F.col(c) for c in flags).alias("n")).where("n != 1").count() == 0
    assert coded.where("v is null").select(F.sum("is_other")).first()[0] == 2


def test_roc_of_three_classes_is_undefined(spark):
    df = spark.createDataFrame([("a", 0.0, 0.1), ("a", 1.0, 0.9), ("b", 0.0, 0.1), ("b", 1.0, 0.9), ("b", 2.0, 0.5)], "m string, y double, score double")
    got = {r["m"]: r["test_roc_auc"] for r in metrics.roc_auc(df, ["m"]).collect()}
    assert got == {"a": 1.0, "b": None}


def test_null_stratum_has_its_share_of_test_rows(spark):
    df = spark.range(60).select("id", F.when(F.col("id") % 3 != 0, (F.col("id") % 3).cast("string")).alias("s"))
    got = {r["s"]: r["n"] for r in split.exact_holdout(df, ["id"], 0.25, strata=["s"]).where("is_test").groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert got == {None: 5, "1": 5, "2": 5}


def test_distinct_labels_are_counted_in_full(spark):
    df = spark.range(5000).select(F.when(F.col("id") > 9, F.col("id")).alias("y"))
    assert grouping.detect_task(df, "y").first()["n_labels"] == 4990


def test_evaluation_without_keys_is_refused(spark):
    with pytest.raises(ValueError, match="key columns"):
        harness.evaluate(spark.range(3), "classification", {"classification": {"models": {}, "Golden Score": {}}})
