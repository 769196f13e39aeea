"""Classifiers whose classes are rows of a table: statistics by one aggregation, rows judged by a join with blocks of classes.

The number of classes has no limit.  Neither the statistics nor the parameters of the classes pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.session import materialize

BLOCK_NUMBERS = 250_000  # parameters that one row of the class table holds


def class_statistics(plain: DataFrame, names: Sequence[str], label: str = "y") -> DataFrame:
    """y, n, mean and cov (the upper triangle of the population covariance, row by row) of every class; updated in the map tasks."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    return plain.groupBy(F.col(label).cast("double").alias("y")).agg(
        F.count("*").alias("n"), F.array(*[F.avg(c) for c in names]).alias("mean"), F.array(*[F.covar_pop(a, b) for a, b in pairs]).alias("cov"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def squared_distance(x: Column, mean: Column, weights: Column | None = None) -> Column:
    squares = F.zip_with(x, mean, lambda a, b: (a - b) * (a - b))
    return total(squares if weights is None else F.zip_with(squares, weights, lambda a, w: a * w))


def choose(df: DataFrame, classes: DataFrame, x: Column, log_score: Callable[[Column, Column], Column], numbers: int) -> DataFrame:
    """``yhat`` is the class with the highest log score (the smaller class on a tie), ``score`` the share of class 1.

    ``classes`` has y and what ``log_score(class, x)`` uses, ``numbers`` values per class.  Classes are packed into blocks, one row each;
    a row of ``df`` meets one block after the other and keeps the best class and the sum so far, so no pair of row and class is a row.
    """
    spots = max(1, BLOCK_NUMBERS // max(1, numbers))
    table = materialize(classes.withColumn("_block", F.lit(0)))
    count = table.count()
    if not count:
        raise ValueError("no rows to fit on")
    n_blocks = -(-count // spots)
    fields = [c for c in classes.columns]
    packed = materialize(table.withColumn("_block", F.pmod(F.xxhash64("y"), F.lit(n_blocks))).groupBy("_block").agg(
        F.collect_list(F.struct(*fields)).alias("_classes")))
    out = df.withColumns({"_x": x, "_best": F.lit(None).cast("struct<l:double,less:double>"), "_sum": F.lit(0.0), "_one": F.lit(None).cast("double")})
    for block in range(n_blocks):
        out = out.join(F.broadcast(packed.where(F.col("_block") == block).select("_classes")), how="left")  # one row
        scored = F.transform("_classes", lambda c: F.struct(log_score(c, F.col("_x")).alias("l"), (-c["y"]).alias("less")))
        out = out.withColumn("_scored", scored).withColumn("_top", F.greatest(F.array_max("_scored"), F.col("_best")))
        here = F.aggregate("_scored", F.lit(0.0), lambda a, s: a + F.exp(s["l"] - F.col("_top.l")))
        before = F.coalesce(F.col("_sum") * F.exp(F.col("_best.l") - F.col("_top.l")), F.lit(0.0))
        one = F.array_max(F.transform(F.filter("_scored", lambda s: s["less"] == -1.0), lambda s: s["l"]))
        out = out.withColumns({"_sum": before + F.coalesce(here, F.lit(0.0)), "_one": F.coalesce("_one", one), "_best": F.col("_top")}).drop(
            "_classes", "_scored", "_top")
    return out.withColumns({"yhat": -F.col("_best.less"), "score": F.exp(F.col("_one") - F.col("_best.l")) / F.col("_sum")}).drop(
        "_x", "_best", "_sum", "_one")


def square(upper: Sequence[float], d: int) -> np.ndarray:
    matrix = np.zeros((d, d))
    matrix[np.triu_indices(d)] = upper
    return matrix + np.triu(matrix, 1).T


def whitening(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """W with (Wx)'(Wx) = x' cov^-1 x, and the logarithm of the determinant, over the directions in which ``cov`` has any width."""
    values, vectors = np.linalg.eigh(cov)
    wide = values > 1e-15 * max(float(values.max()), 0.0) * len(values)
    kept = np.where(wide, values, 1.0)
    return (vectors * np.where(wide, 1.0 / np.sqrt(kept), 0.0)).T, float(np.log(kept).sum())


def whitened_classes(statistics: DataFrame, d: int, pooled: np.ndarray) -> DataFrame:
    """Statistics with ``rows`` (the rows of W, one after the other) and ``logdet`` of each class's own covariance.

    A class of one row has no covariance; it takes the pooled one.
    """

    @F.pandas_udf("rows array<array<double>>, logdet double")
    def of(cov: pd.Series, n: pd.Series) -> pd.DataFrame:
        found = [whitening(square(c, d) * k / (k - 1) if k > 1 else pooled) for c, k in zip(cov, n, strict=True)]
        return pd.DataFrame({"rows": pd.Series([w.tolist() for w, _ in found], dtype=object), "logdet": pd.Series([v for _, v in found], dtype=float)})

    return statistics.withColumn("_w", of("cov", "n")).select("*", "_w.rows", "_w.logdet").drop("_w")
