"""Repeatable holdouts and folds keyed by a digest of the row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldpan.functions.hashing import digest, digest_below, fold_of
from goldpan.operators.ordering import join_null_safe
from goldpan.session import materialize

BUCKET_DIGITS = 5  # 16**5 digest buckets: about n / 1e6 rows in each
FEW_STRATA = 10_000  # up to here a row per stratum is broadcast, so rows are not shuffled by stratum
SALTS = 64  # parts into which the rows of a stratum are dealt beyond that


def holdout(df: DataFrame, keys: Sequence[str], fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test`` for about ``fraction`` of the rows; a narrow projection, no shuffle."""
    return df.withColumn("is_test", digest_below(seed, keys, fraction))


def exact_holdout(
    df: DataFrame, keys: Sequence[str], fraction: float = 0.2, seed: int = 42, strata: Sequence[str] = ()
) -> DataFrame:
    """Adds ``is_test`` for exactly ceil(fraction * n) rows, per stratum if ``strata`` is given.

    The rows with the smallest digests are the test rows.  The cut is found by counting digest buckets and ranking
    only the one bucket that contains it, so no stratum is sorted as a whole.  ``keys`` must identify a row.
    """
    strata = list(strata)
    groups = strata or ["_all"]
    hashed = df.withColumn("_digest", digest(seed, keys))
    if not strata:
        hashed = hashed.withColumn("_all", F.lit(1))
    bucketed = hashed.select(*groups, "_digest", F.substring("_digest", 1, BUCKET_DIGITS).alias("_bucket"))
    # at most 16**5 bucket rows per stratum
    counts = bucketed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy(*groups)
    edge = (
        counts.withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(total)})
        .withColumn("_want", F.ceil(F.col("_total") * F.lit(fraction)))
        .filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
        .select(*groups, "_bucket", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_need"))
    )
    edge = materialize(edge)  # one row per stratum
    few = edge.limit(FEW_STRATA + 1).count() <= FEW_STRATA
    rank = F.row_number().over(Window.partitionBy(*groups, "_bucket").orderBy("_digest"))
    cuts = (
        join_null_safe(bucketed, F.broadcast(edge) if few else edge, [*groups, "_bucket"])
        .filter(F.col("_need").isNotNull())  # only the rows of the bucket with the cut are ranked
        .withColumn("_rank", rank)
        .filter(F.col("_rank") == F.col("_need"))
        .select(*groups, F.col("_digest").alias("_cut"))
    )
    if not strata:
        found = cuts.collect()  # one row
        is_test = F.col("_digest") <= F.lit(found[0]["_cut"]) if found else F.lit(False)
        return hashed.withColumn("is_test", is_test).drop("_digest", "_all")
    if few:
        marked = join_null_safe(hashed, F.broadcast(cuts), groups)
    else:  # a stratum may hold most rows: they are dealt to several tasks, each with its own copy of the cut
        salted = cuts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        marked = join_null_safe(hashed.withColumn("_salt", F.pmod(F.hash("_digest"), F.lit(SALTS))), salted, [*groups, "_salt"]).drop("_salt")
    return marked.withColumn("is_test", F.coalesce(F.col("_digest") <= F.col("_cut"), F.lit(False))).drop("_digest", "_cut")


def repeated_holdout(df: DataFrame, keys: Sequence[str], fraction: float = 0.2, runs: int = 5) -> DataFrame:
    """Every row once per run with its own ``is_test``; the run number is the seed."""
    per_run = df.withColumn("run", F.explode(F.array(*[F.lit(r) for r in range(runs)])))
    return per_run.withColumn("is_test", digest_below(F.col("run"), keys, fraction))


def folds(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` in 0..k-1."""
    return df.withColumn("fold", fold_of(seed, keys, k))
