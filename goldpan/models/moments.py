"""Means and covariances of features: one aggregation, d x d numbers on the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    n: int
    mean: np.ndarray
    cov: np.ndarray  # population covariance


def unpack(df: DataFrame, features: str = "features", extra: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """The features vector as plain columns x0, x1, ..."""
    first = df.select(F.size(vector_to_array(features))).first()
    if first is None:
        raise ValueError("no rows to fit on")
    names = [f"x{i}" for i in range(first[0])]
    array = vector_to_array(features)
    return df.select(*extra, *[F.get(array, F.lit(i)).alias(c) for i, c in enumerate(names)]), names


def _entries(names: Sequence[str]):
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    return [F.count("*")] + [F.avg(c) for c in names] + [F.covar_pop(a, b) for a, b in pairs]


def _moments(row: Sequence, d: int) -> Moments:
    cov = np.zeros((d, d))
    cov[np.triu_indices(d)] = row[1 + d:]
    return Moments(row[0], np.array(row[1:1 + d], dtype=float), cov + np.triu(cov, 1).T)


def overall(df: DataFrame, names: Sequence[str]) -> Moments:
    return _moments(df.agg(*[e.alias(f"e{i}") for i, e in enumerate(_entries(names))]).first(), len(names))
