"""Feature preparation: fit is one aggregation with a bounded result, transform is a narrow projection.

Operators on plain double columns keep the expressions inside code generation.  Where Spark ML has the same
semantics its stages are used; the scalers are composed because Spark ML's use the sample deviation and map a
constant column to 0.5.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.feature import (
    PCA,
    PolynomialExpansion,
    UnivariateFeatureSelector,
    VarianceThresholdSelector,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions.hashing import digest
from goldpan.operators.quantiles import exact_quantiles


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="keep").transform(df)


@dataclass(frozen=True)
class LinearScale:
    """(x - center) / width per column; a column without width becomes 0."""

    columns: tuple[str, ...]
    centers: tuple[float, ...]
    widths: tuple[float, ...]

    def expression(self, i: int) -> Column:
        if not self.widths[i]:
            return F.lit(0.0)
        return (F.col(self.columns[i]) - F.lit(self.centers[i])) / F.lit(self.widths[i])

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        return df.withColumns({f"{prefix}{c}": self.expression(i) for i, c in enumerate(self.columns)})


def fit_standard(df: DataFrame, columns: Sequence[str]) -> LinearScale:
    """Mean and population standard deviation."""
    row = df.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    d = len(columns)
    return LinearScale(tuple(columns), tuple(row[:d]), tuple(row[d:]))


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> LinearScale:
    row = df.agg(*[F.min(c) for c in columns], *[F.max(c) for c in columns]).first()
    d = len(columns)
    return LinearScale(tuple(columns), tuple(map(float, row[:d])), tuple(float(hi - lo) for lo, hi in zip(row[:d], row[d:])))


def fit_robust(df: DataFrame, columns: Sequence[str]) -> LinearScale:
    """Median and interquartile range, exact, without moving or sorting the rows."""
    q = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    return LinearScale(tuple(columns), tuple(q[c][0.5] for c in columns), tuple(q[c][0.75] - q[c][0.25] for c in columns))


def binarize(df: DataFrame, columns: Sequence[str], threshold: float = 0.0) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) > threshold, 1.0).otherwise(0.0) for c in columns})


def zero_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds the number of zero and of non-zero features of a row."""
    zeros = sum((F.when(F.col(c) == 0, 1).otherwise(0) for c in columns), F.lit(0))
    return df.withColumns({"n_zero": zeros, "n_nonzero": F.lit(len(columns)) - zeros})


def frequent_values(df: DataFrame, column: str, minimum_fraction: float) -> list[str]:
    """Values with at least the given share of the rows: no more than 1 / minimum_fraction of them."""
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    total = df.select(F.count("*")).scalar()
    kept = counted.filter(F.col(column).isNotNull() & (F.col("n") >= F.lit(minimum_fraction) * total))
    return sorted(r[0] for r in kept.select(column).collect())


def onehot_minimum_fraction(df: DataFrame, column: str, minimum_fraction: float, prefix: str = "is_") -> DataFrame:
    """Indicator columns for frequent values; all rarer ones and nulls share ``<prefix>other``.

    Column names do not differ by case: of values that do, and of one called ``other``, the later ones get a number.
    """
    kept = frequent_values(df, column, minimum_fraction)
    flags, taken = {}, {f"{prefix}other"}
    for v in kept:
        name, n = f"{prefix}{v.lower()}", 1
        while name in taken:
            n += 1
            name = f"{prefix}{v.lower()}_{n}"
        taken.add(name)
        flags[name] = F.coalesce(F.col(column) == v, F.lit(False)).cast("int")
    rare = ~F.coalesce(F.col(column).isin(kept), F.lit(False))
    return df.withColumns({**flags, f"{prefix}other": rare.cast("int")})


def polynomial(degree: int = 2, source: str = "features", output: str = "poly") -> PolynomialExpansion:
    return PolynomialExpansion(degree=degree, inputCol=source, outputCol=output)


def variance_selector(threshold: float, source: str = "features", output: str = "selected") -> VarianceThresholdSelector:
    return VarianceThresholdSelector(featuresCol=source, outputCol=output, varianceThreshold=threshold)


def univariate_selector(mode: str, threshold: float, categorical_label: bool, label: str = "y",
                        source: str = "features", output: str = "selected") -> UnivariateFeatureSelector:
    """``percentile`` or ``fwe`` selection by the univariate F test that fits the label."""
    selector = UnivariateFeatureSelector(featuresCol=source, outputCol=output, labelCol=label, selectionMode=mode)
    selector.setSelectionThreshold(threshold)
    return selector.setFeatureType("continuous").setLabelType("categorical" if categorical_label else "continuous")


def pca(k: int, source: str = "features", output: str = "pca") -> PCA:
    return PCA(k=k, inputCol=source, outputCol=output)


def union_features(df: DataFrame, branches: Sequence[str], output: str = "features") -> DataFrame:
    """One vector from several branch outputs (vectors or numbers)."""
    return VectorAssembler(inputCols=list(branches), outputCol=output).transform(df)


def importances(model: Model) -> np.ndarray:
    """Per-feature weight of a fitted tree ensemble or linear model."""
    if hasattr(model, "featureImportances"):
        return model.featureImportances.toArray()
    return np.abs(np.asarray(model.coefficients.toArray()))


def map_vectors(df: DataFrame, function: Callable[[np.ndarray], np.ndarray], source: str, output: str) -> DataFrame:
    """A dense vector map as matrix products over Arrow batches.

    Written as column expressions, m outputs of d inputs are m x d nodes and soon exceed what can be compiled.
    """

    @F.pandas_udf("array<double>")
    def mapped(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(function(np.stack(vectors.to_numpy()).astype(float))) if len(vectors) else [])

    return df.withColumn(output, array_to_vector(mapped(vector_to_array(source))))


@dataclass(frozen=True)
class FourierMap:
    """Random Fourier features of an RBF kernel: sqrt(2/m) cos(Wx + b) with a seeded W."""

    weights: np.ndarray  # m x d
    phases: np.ndarray  # m

    @classmethod
    def draw(cls, dims: int, components: int, gamma: float, seed: int = 42) -> FourierMap:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(scale=(2.0 * gamma) ** 0.5, size=(components, dims)), rng.uniform(0, 2 * np.pi, components))

    def function(self) -> Callable[[np.ndarray], np.ndarray]:
        """The map of a matrix of rows, free of this module, which workers need not have."""
        weights, phases = self.weights, self.phases
        factor = (2.0 / len(phases)) ** 0.5
        return lambda x: factor * np.cos(x @ weights.T + phases)

    def transform(self, df: DataFrame, source: str = "features", output: str = "rff") -> DataFrame:
        return map_vectors(df, self.function(), source, output)


@dataclass(frozen=True)
class NystroemMap:
    """RBF kernel values to m landmark rows, whitened by the landmark kernel matrix."""

    landmarks: np.ndarray  # m x d
    whitening: np.ndarray  # m x m
    gamma: float

    @classmethod
    def fit(cls, df: DataFrame, keys: Sequence[str], components: int, gamma: float, source: str = "features", seed: int = 42) -> NystroemMap:
        # the landmark sample is the method itself; its size is fixed by ``components``
        drawn = df.select(vector_to_array(source), *keys).orderBy(digest(seed, keys)).limit(components).collect()
        return cls.at(np.unique(np.array([r[0] for r in drawn]), axis=0), gamma)

    @classmethod
    def at(cls, marks: np.ndarray, gamma: float) -> NystroemMap:
        squared = ((marks[:, None, :] - marks[None, :, :]) ** 2).sum(axis=2)
        u, s, vt = np.linalg.svd(np.exp(-gamma * squared))
        return cls(marks, (u / np.sqrt(np.maximum(s, 1e-12))) @ vt, gamma)

    def transform(self, df: DataFrame, source: str = "features", output: str = "nystroem") -> DataFrame:
        marks, whitening, gamma = self.landmarks, self.whitening, self.gamma

        def kernel(x: np.ndarray) -> np.ndarray:
            squared = (x**2).sum(axis=1)[:, None] - 2 * x @ marks.T + (marks**2).sum(axis=1)
            return np.exp(-gamma * np.maximum(squared, 0)) @ whitening.T

        return map_vectors(df, kernel, source, output)
