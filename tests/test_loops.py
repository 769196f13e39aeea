"""Findings of the review on fits that pass over their rows many times: a pass costs what its rows cost, not partitions or whole forests."""

import threading

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from goldpan.evaluation import harness
from goldpan.models import classifiers, registry
from goldpan.operators import features
from goldpan.queries import models as queries
from goldpan.session import for_loops


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_partitions_of_a_loop_follow_the_rows(spark, many_partitions):
    rows = spark.range(100)
    assert for_loops(rows, ["id"], 100).rdd.getNumPartitions() == 8
    assert for_loops(rows, ["id"], 300_000).rdd.getNumPartitions() == 15
    assert for_loops(rows, ["id"], 10**9).rdd.getNumPartitions() == 64
    assert for_loops(rows, ["id"], 100).count() == 100


def test_a_judged_classifier_gets_few_partitions(spark, many_partitions, tmp_path):
    ids = spark.range(60).select(F.col("id").alias("doc_id"))
    ids.withColumn("text", F.concat(F.lit("some words "), F.col("doc_id"))).write.parquet(f"{tmp_path}/documents.parquet")
    ids.withColumn("quality", F.pmod("doc_id", F.lit(2))).write.parquet(f"{tmp_path}/labels.parquet")
    seen = []

    def fit(train):
        seen.append(train.rdd.getNumPartitions())
        return lambda df: df.withColumns({"yhat": F.lit(0.0), "score": F.lit(0.5)})

    judged = queries._judge_classifier(spark, str(tmp_path), fit).collect()
    assert seen == [8] and judged[0]["test_rows"] == 12


def test_a_forest_keeps_the_nodes_of_its_rows(spark, monkeypatch):
    rows = spark.range(400).select(
        F.rand(1).alias("a"), F.rand(2).alias("b"), (F.rand(3) < 0.3).cast("double").alias("noise")).withColumn(
        "y", F.when(F.col("a") + F.col("b") > 1, 1.0).otherwise(F.col("noise")))
    train = features.assemble(rows.repartition(3), ["a", "b"]).persist()
    kept, real = [], RandomForestClassifier._fit

    def spied(self, data):
        kept.append(self.getCacheNodeIds())
        return real(self, data)

    monkeypatch.setattr(RandomForestClassifier, "_fit", spied)
    ours = classifiers.forest(10, 12)(train)(train).agg(F.sum("score")).first()[0]
    plain = RandomForestClassifier(labelCol="y", numTrees=10, maxDepth=12, seed=42).fit(train).transform(train)
    assert kept == [True, False]
    assert ours == pytest.approx(plain.agg(F.sum(classifiers.second("probability"))).first()[0])


def test_a_run_does_not_wait_for_the_last_fit_of_the_run_before(spark, many_partitions):
    rows = spark.range(60).select(F.col("id").alias("row_id"), F.col("id").cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("y"))
    ahead, started, partitions = threading.Event(), [], []

    def predict(df):
        return df.withColumns({"yhat": F.lit(0.0), "score": F.lit(0.5)})

    def slow(train):
        started.append("slow")
        if len(started) == 1 and not ahead.wait(60):
            raise TimeoutError("the next run had not begun")
        ahead.set()
        partitions.append(train.rdd.getNumPartitions())
        return predict

    status = harness.fit_all(rows, "classification", ["a"], {"slow": slow}, ["row_id"], lambda name, run, out: out.count(), runs=3)
    assert [(r["run"], r["status"]) for r in status.orderBy("run").collect()] == [(0, "ok"), (1, "ok"), (2, "ok")]
    assert partitions == [8, 8, 8]


def test_a_failed_fit_ends_an_evaluation(spark, tmp_path, monkeypatch):
    """Scores are normalized over all models: a leaderboard without some of them looks like a result and is none."""
    ids = spark.range(60).select(F.col("id").alias("doc_id"))
    ids.withColumn("text", F.concat(F.lit("some words "), F.col("doc_id"))).write.parquet(f"{tmp_path}/documents.parquet")
    ids.withColumn("quality", F.pmod("doc_id", F.lit(2))).write.parquet(f"{tmp_path}/labels.parquet")
    begun = []

    def broken(train):
        begun.append("broken")
        if len(begun) == 2:
            raise RuntimeError("no memory left")
        return lambda df: df.withColumns({"yhat": F.lit(0.0), "score": F.lit(0.5)})

    some = {"Broken": lambda **p: broken, "Gaussian Naive Bayes": classifiers.gaussian_nb}
    monkeypatch.setattr(registry, "CLASSIFIERS", some)
    monkeypatch.setitem(registry.MODELS, "classification", some)
    with pytest.raises(RuntimeError, match="Broken, run [01]: RuntimeError: no memory left"):
        queries.eval_classification(spark, str(tmp_path))
    assert 2 <= len(begun) <= 4

    rows = ids.select(F.col("doc_id").alias("row_id"), F.col("doc_id").cast("double").alias("a"), F.col("doc_id").cast("double").alias("y"))
    with pytest.raises(ValueError, match="no regression model 'Nothing'"):
        harness.evaluate_regression(rows, ["a"], {"Nothing": None}, ["row_id"])
    board, status = harness.evaluate(rows, "regression", {"regression": {"models": {"Nothing": None, "Linear Regression": None}, "Golden Score": {"MAE": 1.0}}},
                                     ["a"], ["row_id"], runs=1)
    assert {(r["model"], r["status"]) for r in status.collect()} == {("Nothing", "failed"), ("Linear Regression", "ok")} and board.count() == 1
