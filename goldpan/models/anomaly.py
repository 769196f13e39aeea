"""Outlier detectors: isolation forest, local outlier factor, elliptic envelope."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.models.moments import overall, unpack
from goldpan.operators.neighbors import Join, knn_join
from goldpan.operators.ordering import top_per_group
from goldpan.session import materialize

SAMPLE_ROWS = 256
DRAWN = 2 * SAMPLE_ROWS  # rows expected below a tree's threshold; fewer than SAMPLE_ROWS have a probability of e^-78
NODES = "tree int, node int, feature int, threshold double, left int, right int, depth int, rows int"


def _expected_depth(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe))


def _grow(seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        pdf = pdf.sort_values("digest", kind="stable")
        data = np.stack(pdf["v"].to_numpy()).astype(float)
        limit = math.ceil(math.log2(max(len(data), 2)))
        nodes: list[list] = []
        todo = [(np.arange(len(data)), 0, -1, 0)]
        while todo:
            rows, depth, parent, side = todo.pop()
            at = len(nodes)
            if parent >= 0:
                nodes[parent][4 + side] = at
            low, high = data[rows].min(axis=0), data[rows].max(axis=0)
            open_features = np.flatnonzero(high > low)
            if depth >= limit or len(rows) <= 1 or not len(open_features):
                nodes.append([tree, at, -1, 0.0, -1, -1, depth, len(rows)])
                continue
            f = int(rng.choice(open_features))
            cut = float(rng.uniform(low[f], high[f]))
            nodes.append([tree, at, f, cut, -1, -1, depth, len(rows)])
            below = data[rows, f] <= cut
            todo += [(rows[below], depth + 1, at, 0), (rows[~below], depth + 1, at, 1)]
        return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODES.split(", ")])

    return grow


def _samples(rows: DataFrame, n: int, trees: int, seed: int, row_id: str) -> DataFrame:
    """For each tree the SAMPLE_ROWS rows of the whole table with the smallest hashes of its own; a threshold spares sorting the rest."""
    share = DRAWN / max(n, 1)
    while True:
        least = F.lit(2**63 - 1 if share >= 1 else int(share * 2**64) - 2**63).cast("long")

        def of_tree(t):
            return F.xxhash64(F.lit(seed), t, F.col(row_id))

        every = F.sequence(F.lit(0), F.lit(trees - 1))
        per_tree = rows.withColumn("tree", F.explode(F.filter(every, lambda t: of_tree(t) <= least))).withColumn("digest", of_tree(F.col("tree")))
        samples = materialize(top_per_group(per_tree, ["tree"], [F.col("digest")], SAMPLE_ROWS, "_rank"))
        # ids that repeat share a hash, so fewer rows than expected may be below the threshold
        if share >= 1 or samples.count() >= trees * min(n, SAMPLE_ROWS):
            return samples
        share *= 8


def isolation_forest(df: DataFrame, trees: int = 100, seed: int = 42, row_id: str = "row_id", features: str = "features") -> DataFrame:
    """Adds ``anomaly_score`` in (0, 1] and ``is_outlier`` (score above one half).

    Each tree is grown in its own task from a fixed-size keyed sample of the whole table, which is the method itself; every row of
    the table is scored.  All trees together have at most trees x 511 nodes and travel with the scoring function.
    """
    n = df.count()
    samples = _samples(df.select(F.col(row_id), vector_to_array(features).alias("v")), n, trees, seed, row_id)
    grown = samples.groupBy("tree").applyInPandas(_grow(seed), NODES).toPandas().sort_values(["tree", "node"])
    forest = [g[["feature", "threshold", "left", "right", "depth", "rows"]].to_numpy() for _, g in grown.groupby("tree")]
    normal = float(_expected_depth(min(n, SAMPLE_ROWS))) or 1.0

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series(dtype=float)
        x = np.stack(vectors.to_numpy()).astype(float)
        total = np.zeros(len(x))
        for nodes in forest:
            feature, left, right = nodes[:, 0].astype(int), nodes[:, 2].astype(int), nodes[:, 3].astype(int)
            at = np.zeros(len(x), dtype=int)
            active = feature[at] >= 0
            while active.any():
                rows = np.flatnonzero(active)
                here = at[rows]
                at[rows] = np.where(x[rows, feature[here]] <= nodes[here, 1], left[here], right[here])
                active = feature[at] >= 0
            total += nodes[at, 4] + _expected_depth(nodes[at, 5])
        return pd.Series(2.0 ** (-total / len(forest) / normal))

    return df.withColumn("anomaly_score", score(vector_to_array(features))).withColumn("is_outlier", F.col("anomaly_score") > 0.5)


def local_outlier_factor(df: DataFrame, k: int = 20, row_id: str = "row_id", vector: str = "v", join: Join = knn_join) -> DataFrame:
    """(row_id, lof): density of the neighbours, found by ``join``, relative to the own density; above 1 means sparser."""
    near = materialize(join(df, df, k, row_id, row_id, vector, vector, exclude_self=True))
    reach_of = near.groupBy(F.col("query_id").alias("ref_id")).agg(F.max("distance").alias("_k_distance"))
    reach = near.join(reach_of, "ref_id").withColumn("_reach", F.greatest("distance", "_k_distance"))
    density = materialize(reach.groupBy("query_id").agg((1 / (F.avg("_reach") + F.lit(1e-10))).alias("_density")))
    of_neighbours = near.join(density.withColumnsRenamed({"query_id": "ref_id", "_density": "_other"}), "ref_id")
    ratio = of_neighbours.groupBy("query_id").agg(F.avg("_other").alias("_mean")).join(density, "query_id")
    return ratio.select(F.col("query_id").alias(row_id), (F.col("_mean") / F.col("_density")).alias("lof"))


def mahalanobis(df: DataFrame, support: float = 1.0, steps: int = 10, features: str = "features") -> DataFrame:
    """Adds ``distance2`` to the robust centre.

    With ``support`` below 1 the centre and covariance are refitted on that share of closest rows until the
    covariance stops shrinking; each step is one aggregation, and the cut is a mergeable quantile sketch.
    """
    plain, names = unpack(df, features)
    m = overall(plain, names)

    def distance(array, moments):
        inverse = np.linalg.pinv(moments.cov)
        d = [F.get(array, F.lit(i)) - F.lit(float(c)) for i, c in enumerate(moments.mean)]
        terms = [d[i] * d[j] * F.lit(float(inverse[i, j])) for i in range(len(d)) for j in range(len(d))]
        return sum(terms, F.lit(0.0))

    if support < 1:
        volume = np.linalg.slogdet(m.cov)[1]
        columns = F.array(*names)
        for _ in range(steps):
            measured = plain.withColumn("_d", distance(columns, m))
            cut = measured.agg(F.percentile_approx("_d", support, 10_000)).first()[0]
            refit = overall(measured.filter(F.col("_d") <= cut), names)
            now = np.linalg.slogdet(refit.cov)[1]
            m = refit
            if not np.isfinite(now) or volume - now < 1e-9:
                break
            volume = now
    return df.withColumn("distance2", distance(vector_to_array(features), m))


def elliptic_envelope(df: DataFrame, contamination: float = 0.1, support: float | None = None, features: str = "features") -> DataFrame:
    """Adds ``distance2`` and ``is_outlier`` for about the ``contamination`` share of the rows farthest from the centre."""
    if support is None:
        d = df.select(F.size(vector_to_array(features))).first()[0]
        n = df.count()
        support = min(1.0, (n + d + 1) / (2 * n))
    measured = mahalanobis(df, support, features=features)
    cut = measured.agg(F.percentile_approx("distance2", 1 - contamination, 10_000)).first()[0]
    return measured.withColumn("is_outlier", F.col("distance2") > F.lit(cut))


# ---------------------------------------------------------------- by configuration

Detector = Callable[[DataFrame], DataFrame]  # rows with row_id and features -> row_id, score (larger: more unusual), is_outlier


def forest_detector(trees: int = 100, seed: int = 42) -> Detector:
    return lambda df: isolation_forest(df, trees, seed).select("row_id", F.col("anomaly_score").alias("score"), "is_outlier")


def neighbour_detector(k: int = 20, join: Join = knn_join) -> Detector:
    """A row whose neighbours lie one and a half times as dense as itself is an outlier."""

    def detect(df: DataFrame) -> DataFrame:
        rows = df.select("row_id", vector_to_array("features").alias("v"))
        return local_outlier_factor(rows, k, join=join).select("row_id", F.col("lof").alias("score"), (F.col("lof") > 1.5).alias("is_outlier"))

    return detect


def envelope_detector(contamination: float = 0.1, support: float | None = None) -> Detector:
    return lambda df: elliptic_envelope(df, contamination, support).select("row_id", F.col("distance2").alias("score"), "is_outlier")
