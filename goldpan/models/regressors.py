"""Regressors: Spark ML with matched penalties, a Bayesian ridge on the Gram matrix, boosting loops."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from goldpan.models.base import Fit, Predict, from_estimator, no_score
from goldpan.models.moments import overall, unpack
from goldpan.operators.features import FourierMap
from goldpan.operators.neighbors import Join, knn_join
from goldpan.session import materialize

CHECKPOINT_ROUNDS = 10

# fixed values: rounds, depth, step, bins and row share of the boosting presets
BOOSTING_PRESETS = {
    "gradient": {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "maxBins": 256, "subsamplingRate": 1.0},
    "histogram": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "maxBins": 255, "subsamplingRate": 1.0},
    "depthwise": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.3, "maxBins": 256, "subsamplingRate": 1.0},
    "leafwise": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "maxBins": 255, "subsamplingRate": 1.0},
    "symmetric": {"maxIter": 1000, "maxDepth": 6, "stepSize": 0.03, "maxBins": 254, "subsamplingRate": 0.8},
}


def linear_1d(df: DataFrame, x: str, y: str, groups: tuple[str, ...] = ()) -> DataFrame:
    """Slope and intercept of one feature by built-in aggregates."""
    return df.groupBy(*groups).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def linear() -> Fit:
    return from_estimator(LinearRegression(labelCol="y", solver="normal"))


def ridge(alpha: float = 1.0) -> Fit:
    def fit(train: DataFrame) -> Predict:
        estimator = LinearRegression(labelCol="y", regParam=alpha / train.count(), elasticNetParam=0.0, standardization=False, solver="normal")
        return from_estimator(estimator)(train)

    return fit


def elastic_net(alpha: float = 1.0, l1_ratio: float = 0.5) -> Fit:
    return from_estimator(LinearRegression(labelCol="y", regParam=alpha, elasticNetParam=l1_ratio, standardization=False))


def lasso(alpha: float = 1.0) -> Fit:
    return elastic_net(alpha, 1.0)


def cross_validated(alphas: tuple[float, ...] = (0.001, 0.1, 1.0), l1_ratio: float = 0.0, folds: int = 5, parallelism: int = 2) -> Fit:
    """Penalty chosen by cross validation; rows carry their ``fold``."""
    estimator = LinearRegression(labelCol="y", elasticNetParam=l1_ratio, standardization=False)
    grid = ParamGridBuilder().addGrid(estimator.regParam, list(alphas)).build()
    return from_estimator(CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y", metricName="mse"),
        numFolds=folds, foldCol="fold", parallelism=parallelism))


def huber(epsilon: float = 1.35, max_iter: int = 100) -> Fit:
    """Robust linear fit with the Huber loss."""
    return from_estimator(LinearRegression(labelCol="y", loss="huber", epsilon=epsilon, maxIter=max_iter))


BLOCK_ROWS = 65_536  # rows of a stored block
SLICE_ROWS = 8_192  # rows whose Fourier features exist at a time


def _packed(train: DataFrame) -> DataFrame:
    """``features`` and ``y`` as blocks of plain numbers: a pass over them costs no row format."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys, rows = [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"x": [np.concatenate(xs).tobytes()], "y": [np.concatenate(ys).tobytes()]},
                                              pa.schema([("x", pa.binary()), ("y", pa.binary())]))

        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float)
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            if batch.column(0).null_count or not (np.isfinite(x).all() and np.isfinite(y).all()):
                raise ValueError("features and y must be finite numbers")
            xs.append(x)
            ys.append(y)
            rows += len(y)
            if rows >= BLOCK_ROWS:
                yield block()
                xs, ys, rows = [], [], 0
        if rows:
            yield block()

    return train.select(vector_to_array("features").alias("x"), F.col("y").cast("double").alias("y")).mapInArrow(pack, "x binary, y binary")


def _sums(blocks: DataFrame, lift: Callable[[np.ndarray], np.ndarray], d: int, m: int, at: np.ndarray, sigma: float, epsilon: float) -> list[np.ndarray]:
    """One pass: what the Huber loss of ``m`` lifted features (and an intercept) at a point, its gradient and its curvature consist of.

    Over the rows with a residual r of at most epsilon sigma: x x', x r, and r r and their number; over the others: x sign(r) and |r|.
    """

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, along, outside, rest = np.zeros((m + 1, m + 1)), np.zeros(m + 1), np.zeros(m + 1), np.zeros(4)
        for batch in batches:
            for raw_x, raw_y in zip(batch.column(0), batch.column(1), strict=True):
                xs, ys = np.frombuffer(raw_x.as_buffer()).reshape(-1, d), np.frombuffer(raw_y.as_buffer())
                for start in range(0, len(ys), SLICE_ROWS):
                    y = ys[start:start + SLICE_ROWS]
                    x = np.hstack([lift(xs[start:start + SLICE_ROWS]), np.ones((len(y), 1))])
                    r = y - x @ at
                    inside = np.abs(r) <= epsilon * sigma
                    near = np.where(inside, r, 0.0)
                    far = np.where(inside, 0.0, r)
                    square += (x * inside[:, None]).T @ x
                    along += near @ x
                    outside += np.sign(far) @ x
                    rest += near @ near, inside.sum(), np.abs(far).sum(), len(y)
        values = np.concatenate([square.ravel(), along, outside, rest])
        yield pa.RecordBatch.from_pydict({"sums": [values.tobytes()]}, pa.schema([("sums", pa.binary())]))

    total = sum(np.frombuffer(row[0]) for row in blocks.mapInArrow(of_partition, "sums binary").collect())
    return [part.reshape(shape) for part, shape in zip(
        np.split(total, np.cumsum([(m + 1) ** 2, m + 1, m + 1])), ((m + 1, m + 1), -1, -1, -1), strict=True)]


def _huber_newton(blocks: DataFrame, lift: Callable[[np.ndarray], np.ndarray], d: int, m: int, epsilon: float = 1.35, passes: int = 100,
                  tolerance: float = 1e-12) -> np.ndarray:
    """Coefficients and intercept with the least Huber loss, whose scale sigma is fitted along with them.

    The loss is convex and, while no residual changes sides, quadratic in the coefficients, so a few steps of Newton's method do, of
    one pass each.  The first pass is least squares.
    """
    square, along, _, rest = _sums(blocks, lift, d, m, np.zeros(m + 1), math.inf, epsilon)
    first = np.linalg.lstsq(square, along, rcond=1e-12)[0]
    spread = max(float(rest[0] - 2 * first @ along + first @ square @ first), 0.0) / rest[3]
    least = 1e-9 * max(math.sqrt(rest[0] / rest[3]), 1e-300)
    point, step = np.append(first, max(math.sqrt(spread), least)), None
    value, slope = math.inf, 0.0
    for _ in range(passes):
        sigma = point[-1]
        square, along, outside, (squares, inside, distance, n) = _sums(blocks, lift, d, m, point[:-1], sigma, epsilon)
        here = (n * sigma + squares / sigma + 2 * epsilon * distance - (n - inside) * epsilon**2 * sigma) / (2 * n)
        if step is not None and here > value + 1e-4 * slope + 1e-15 * abs(value):
            step, slope = step / 2, slope / 2  # too far
            if np.abs(step).max() <= 1e-14 * np.abs(point).max():
                return (point - 2 * step)[:-1]
            point = point - step
            continue
        value = here
        gradient = np.append(-along / sigma - epsilon * outside, (n - squares / sigma**2 - (n - inside) * epsilon**2) / 2) / n
        curvature = np.zeros((m + 2, m + 2))
        curvature[:-1, :-1] = square / sigma / n
        curvature[-1, :-1] = curvature[:-1, -1] = along / sigma**2 / n
        curvature[-1, -1] = squares / sigma**3 / n
        step = -np.linalg.lstsq(curvature, gradient, rcond=1e-13)[0]
        slope = float(gradient @ step)
        if -slope <= tolerance * abs(value) or (sigma <= least and step[-1] < 0):
            break
        if sigma + step[-1] < sigma / 4:  # the scale stays above zero
            share = 0.75 * sigma / -step[-1]
            step, slope = share * step, share * slope
        point = point + step
    return point[:-1]


def rff_huber(components: int = 100, gamma: float | None = None, seed: int = 42) -> Fit:
    """Huber fit on random Fourier features.  They are made anew in every pass: storing them takes components / features the room."""

    def fit(train: DataFrame) -> Predict:
        d = train.select(F.size(vector_to_array("features"))).first()[0]
        lift = FourierMap.draw(d, components, gamma or 1.0 / d, seed).function()
        blocks = _packed(train).persist()
        fitted = _huber_newton(blocks, lift, d, components)
        blocks.unpersist()
        weights, intercept = fitted[:-1], fitted[-1]

        @F.pandas_udf(DoubleType())
        def value(vectors: pd.Series) -> pd.Series:
            return pd.Series(lift(np.stack(vectors.to_numpy())) @ weights + intercept if len(vectors) else [], dtype=float)

        return lambda df: df.withColumn("yhat", value(vector_to_array("features"))).withColumn("score", no_score())

    return fit


def tree(max_depth: int = 30, seed: int = 42) -> Fit:
    return from_estimator(DecisionTreeRegressor(labelCol="y", maxDepth=max_depth, seed=seed))


def forest(num_trees: int = 100, max_depth: int = 30, subset: str = "all", seed: int = 42) -> Fit:
    return from_estimator(RandomForestRegressor(labelCol="y", numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy=subset, seed=seed))


def boosting(preset: str = "gradient", seed: int = 42, **override) -> Fit:
    options = BOOSTING_PRESETS[preset] | override
    return from_estimator(GBTRegressor(labelCol="y", seed=seed, checkpointInterval=CHECKPOINT_ROUNDS, **options))


def polynomial(degree: int = 2) -> Fit:
    expand = PolynomialExpansion(degree=degree, inputCol="features", outputCol="_poly")
    return from_estimator(Pipeline(stages=[expand, LinearRegression(labelCol="y", featuresCol="_poly")]))


def bayesian_ridge(max_iter: int = 300, tolerance: float = 1e-3, prior: float = 1e-6) -> Fit:
    """Noise and weight precision by evidence maximization on the d x d Gram matrix.

    The data is read once for the moments; the iteration runs on d x d numbers.
    """

    def fit(train: DataFrame) -> Predict:
        plain, names = unpack(train, extra=["y"])
        m = overall(plain, [*names, "y"])
        gram, xy, yy = m.cov[:-1, :-1] * m.n, m.cov[:-1, -1] * m.n, m.cov[-1, -1] * m.n
        values, vectors = np.linalg.eigh(gram)
        values = np.maximum(values, 0)
        noise, weight = 1.0 / max(yy / m.n, 1e-12), 1.0
        beta = np.zeros(len(names))
        for _ in range(max_iter):
            previous = beta
            beta = vectors @ ((vectors.T @ xy) / (values + weight / noise))
            effective = float((noise * values / (weight + noise * values)).sum())
            rest = max(float(yy - 2 * beta @ xy + beta @ gram @ beta), 0.0)
            weight = (effective + 2 * prior) / (float(beta @ beta) + 2 * prior)
            noise = (m.n - effective + 2 * prior) / (rest + 2 * prior)
            if np.abs(beta - previous).sum() < tolerance:
                break
        intercept = float(m.mean[-1] - beta @ m.mean[:-1])

        def predict(df: DataFrame) -> DataFrame:
            x = vector_to_array("features")
            terms = sum((F.get(x, F.lit(i)) * F.lit(float(b)) for i, b in enumerate(beta)), F.lit(intercept))
            return df.withColumn("yhat", terms).withColumn("score", no_score())

        return predict

    return fit


def knn(k: int = 5, join: Join = knn_join) -> Fit:
    """Mean of the k nearest training rows, found by ``join``; rows carry a unique ``row_id``."""

    def fit(train: DataFrame) -> Predict:
        refs = train.select(F.col("row_id").alias("ref_id"), vector_to_array("features").alias("v"), F.col("y").alias("_target"))

        def predict(df: DataFrame) -> DataFrame:
            asked = df.withColumn("_v", vector_to_array("features"))
            near = join(asked, refs, k, "row_id", "ref_id", "_v", "v").join(refs.select("ref_id", "_target"), "ref_id")
            means = near.groupBy(F.col("query_id").alias("row_id")).agg(F.avg("_target").alias("yhat"))
            return df.join(means, "row_id").withColumn("score", no_score())

        return predict

    return fit


def _weighted_median(df: DataFrame, output: str, values: list[str], weights: list[float]) -> DataFrame:
    """Adds the first value in ascending order at which the weights reach half of their sum, by expressions: no Python worker takes memory."""
    votes = F.array_sort(F.array(*[F.struct(F.col(v).alias("v"), F.lit(i).alias("i"), F.lit(float(w)).alias("w"))
                                   for i, (v, w) in enumerate(zip(values, weights, strict=True))]))
    start = F.struct(F.lit(0.0).alias("upto"), F.lit(None).cast("double").alias("v"))

    def further(at: Column, vote: Column) -> Column:
        upto = at["upto"] + vote["w"]
        return F.struct(upto.alias("upto"), F.when(at["v"].isNull() & (upto >= F.col("_half")), vote["v"]).otherwise(at["v"]).alias("v"))

    halves = df.withColumn("_votes", votes).withColumn("_half", F.aggregate("_votes", F.lit(0.0), lambda upto, vote: upto + vote["w"]) / 2)
    return halves.withColumn(output, F.aggregate("_votes", start, further, lambda at: at["v"])).drop("_votes", "_half")


def adaboost(rounds: int = 50, learning_rate: float = 1.0, max_depth: int = 3, seed: int = 42) -> Fit:
    """Boosting for regression with a linear loss: rows with large errors gain weight, the weighted median predicts."""

    def fit(train: DataFrame) -> Predict:
        current = train.select("features", "y").withColumn("_w", F.lit(1.0)).persist()
        members: list[tuple] = []
        for i in range(1, rounds + 1):
            member = DecisionTreeRegressor(labelCol="y", weightCol="_w", maxDepth=max_depth, seed=seed).fit(current)
            judged = member.transform(current).withColumn("_e", F.abs(F.col("prediction") - F.col("y")))
            worst, lost, total = judged.agg(F.max("_e"), F.sum(F.col("_w") * F.col("_e")), F.sum("_w")).first()
            loss = lost / worst / total if worst > 0 else 0.0
            if loss >= 0.5:
                if not members:
                    members.append((member, 1.0))
                break
            if loss == 0:
                members.append((member, 1.0))
                break
            beta = loss / (1 - loss)
            members.append((member, learning_rate * math.log(1 / beta)))
            factor = F.pow(F.lit(beta), F.lit(learning_rate) * (1 - F.col("_e") / F.lit(worst)))
            lighter = judged.withColumn("_w", F.col("_w") * factor / F.lit(total / 1e3)).select("features", "y", "_w")
            following = materialize(lighter) if i % CHECKPOINT_ROUNDS == 0 else lighter.persist()
            following.count()
            current.unpersist()
            current = following
        current.unpersist()

        def predict(df: DataFrame) -> DataFrame:
            out = df
            for i, (member, _) in enumerate(members):
                out = member.transform(out).withColumnRenamed("prediction", f"_p{i}")
            names = [f"_p{i}" for i in range(len(members))]
            return _weighted_median(out, "yhat", names, [v for _, v in members]).withColumn("score", no_score()).drop(*names)

        return predict

    return fit
