"""Classifiers whose classes are rows of a table."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from goldpan.models import class_tables, classifiers


def frame(spark, x, y):
    rows = [(i, [float(v) for v in row], float(c)) for i, (row, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row_id long, v array<double>, y double")
    return df.select("row_id", array_to_vector("v").alias("features"), "y")


MODELS = {"gaussian": classifiers.gaussian_nb, "bernoulli": classifiers.bernoulli_nb,
          "quadratic": lambda: classifiers.discriminant(False), "linear": lambda: classifiers.discriminant(True)}


@pytest.mark.parametrize("name", ["gaussian", "quadratic", "linear"])
def test_five_thousand_classes(spark, name):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(15_000, 2)) * 0.05
    y = np.arange(15_000) % 5_000
    x[:, 0] += y % 71
    x[:, 1] += y // 71
    df = frame(spark, x, y).repartition(4)
    out = MODELS[name]()(df)(df.where("row_id < 200"))
    assert out.where("yhat = y").count() >= 190
    assert out.columns == ["row_id", "features", "y", "yhat", "score"]


def plain(name, x, y, asked):
    """Log scores by numpy, one class at a time."""
    classes = np.unique(y)
    logs = []
    variance = 1e-9 * x.var(axis=0).max()
    pooled = sum(np.cov(x[y == c].T, ddof=0) * (y == c).sum() for c in classes) / (len(y) - len(classes))
    for c in classes:
        own = x[y == c]
        prior = np.log(len(own) / len(y))
        off = asked - own.mean(axis=0)
        if name == "gaussian":
            v = own.var(axis=0) + variance
            logs.append(prior - 0.5 * np.log(2 * np.pi * v).sum() - (off**2 / (2 * v)).sum(axis=1))
        elif name == "bernoulli":
            share = ((own > 0).sum(axis=0) + 1) / (len(own) + 2)
            logs.append(prior + np.where(asked > 0, np.log(share), np.log(1 - share)).sum(axis=1))
        else:
            cov = pooled if name == "linear" else np.cov(own.T)
            logs.append(prior - (0 if name == "linear" else 0.5 * np.linalg.slogdet(cov)[1]) - 0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off))
    logs = np.stack(logs, axis=1)
    shares = np.exp(logs - logs.max(axis=1, keepdims=True))
    shares /= shares.sum(axis=1, keepdims=True)
    return classes[logs.argmax(axis=1)], shares[:, list(classes).index(1.0)]


@pytest.mark.parametrize("name", MODELS)
@pytest.mark.parametrize("numbers", [250_000, 3])
def test_equal_to_numpy_in_one_block_and_in_many(spark, monkeypatch, name, numbers):
    monkeypatch.setattr(class_tables, "BLOCK_NUMBERS", numbers)
    rng = np.random.default_rng(9)
    y = rng.integers(0, 6, 400).astype(float)
    x = rng.normal(size=(400, 3)) + y[:, None] * [0.6, -0.3, 0.0]
    df = frame(spark, x, y)
    out = MODELS[name]()(df)(df).orderBy("row_id").toPandas()
    yhat, score = plain(name, x, y, x)
    assert (out["yhat"].to_numpy() == yhat).all()
    assert np.allclose(out["score"], score, atol=1e-9)


def test_classes_of_one_row_and_without_width(spark):
    x = np.array([[0.0, 0.0], [0.1, 0.0], [0.0, 0.1], [5.0, 5.0], [9.0, 9.0], [9.0, 9.0]])
    y = np.array([0, 0, 0, 1, 2, 2])
    df = frame(spark, x, y)
    out = classifiers.discriminant(False)(df)(df)
    assert out.where("row_id < 3 and yhat = 0").count() == 3 and out.where("yhat is null").count() == 0
    none = classifiers.gaussian_nb()(df.where("y <> 1"))(df)
    assert none.where("score is not null").count() == 0 and none.agg(F.count("yhat")).first()[0] == 6
    with pytest.raises(ValueError, match="no rows"):
        classifiers.gaussian_nb()(df.limit(0))
