"""Findings of the review on fits over tables far larger than memory: few passes, little stored, no more than that."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from goldpan.models import regressors
from goldpan.operators import features
from goldpan.operators.features import FourierMap


@pytest.fixture(scope="module")
def lines(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 3))
    y = 3 * np.sin(x[:, 0]) + x[:, 1] ** 2 + rng.standard_t(2, size=900)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)]
    return features.assemble(spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(5), ["a", "b", "c"]).cache()


def test_the_robust_kernel_fit_needs_few_passes(lines, monkeypatch):
    passes, real = [], regressors._sums
    monkeypatch.setattr(regressors, "_sums", lambda *given: passes.append(1) or real(*given))
    ours = regressors.rff_huber(12)(lines)(lines)
    assert len(passes) <= 15
    lifted = FourierMap.draw(3, 12, 1 / 3, 42).transform(lines)
    exact = LinearRegression(labelCol="y", featuresCol="rff", loss="huber", tol=1e-13, maxIter=2000).fit(lifted).transform(lifted)
    got = [r[0] for r in ours.orderBy("a").select("yhat").collect()]
    assert got == pytest.approx([r[0] for r in exact.orderBy("a").select("prediction").collect()], abs=2e-3)
    assert ours.columns == [*lines.columns, "yhat", "score"]


def test_the_robust_kernel_fit_on_odd_rows(spark, lines):
    flat = lines.withColumn("y", F.lit(2.0))
    assert [r[0] for r in regressors.rff_huber(4)(flat)(flat).limit(3).select("yhat").collect()] == pytest.approx([2.0] * 3)
    few = features.assemble(spark.createDataFrame([(0.0, 1.0), (1.0, 5.0)], "a double, y double").coalesce(1), ["a"])
    assert [r[0] for r in regressors.rff_huber(4)(few)(few).orderBy("a").select("yhat").collect()] == pytest.approx([1.0, 5.0], abs=1e-6)
    for wrong in ("null", "'NaN'"):
        with pytest.raises(Exception, match="finite"):
            regressors.rff_huber(4)(lines.withColumn("y", F.expr(f"IF(a > 1, CAST({wrong} AS DOUBLE), y)")))


def test_the_weighted_median_is_an_expression(spark):
    rng = np.random.default_rng(3)
    for weights in ([0.5], [1.0, 1.0], [0.2, 0.9, 0.4, 0.4], list(map(float, rng.uniform(0, 2, 9)))):
        values = rng.integers(0, 4, size=(40, len(weights))) / 2
        names = [f"p{i}" for i in range(len(weights))]
        df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(values)], ["id", *names])
        found = regressors._weighted_median(df, "m", names, weights)
        order = values.argsort(axis=1, kind="stable")
        upto = np.array(weights)[order].cumsum(axis=1)
        expected = np.take_along_axis(values, order, axis=1)[np.arange(40), (upto >= upto[:, -1:] / 2).argmax(axis=1)]
        assert [r["m"] for r in found.orderBy("id").collect()] == expected.tolist() and found.columns == ["id", *names, "m"]


def test_adaboost_predicts_without_python(lines):
    predicted = regressors.adaboost(3)(lines)(lines)
    plan = predicted._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert predicted.where("yhat IS NULL").isEmpty() and predicted.columns == [*lines.columns, "yhat", "score"]
