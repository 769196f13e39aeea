"""What the evaluation needs from a model: ``fit`` on rows with ``features`` and ``y``, then rows with ``yhat``/``score``.

``score`` is the probability or decision value of class 1, null for a model that offers none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Predict = Callable[[DataFrame], DataFrame]
Fit = Callable[[DataFrame], Predict]


def no_score() -> Column:
    return F.lit(None).cast("double")


def second(vector: str) -> Column:
    """Entry of class 1 in a probability or raw-prediction vector."""
    return F.get(vector_to_array(vector), F.lit(1))


def from_estimator(estimator: Estimator) -> Fit:
    """A Spark ML estimator (or pipeline ending in one) as a model."""
    return lambda train: fitted(estimator.fit(train))


def fitted(model: Model) -> Predict:
    """A fitted Spark ML model as a function that adds ``yhat`` and ``score``."""

    def predict(df: DataFrame) -> DataFrame:
        out = model.transform(df).withColumnRenamed("prediction", "yhat")
        if "probability" in out.columns:
            score = second("probability")
        elif "rawPrediction" in out.columns:
            score = second("rawPrediction")
        else:
            score = no_score()
        return out.withColumn("score", score).drop("probability", "rawPrediction")

    return predict
