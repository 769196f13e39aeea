"""Positions and running totals that never put one group into one task.

A plain ``row_number() over (partition by g order by o)`` sorts all rows of ``g`` in a single task.  Where a group
may be unbounded (raw events of one source, all rows of one label) the functions below range-partition the rows by
(group, order), work inside each range, and add a per-range offset.  The offset table has at most one row per range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.session import materialize

RANGE = "_range"


def into_ranges(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range-partition by ``keys`` and label every row with its range.

    The result is written once: range borders come from sampling, so two evaluations of the exchange could cut
    differently, and all branches that combine range offsets must see the same cut.
    """
    return materialize(df.repartitionByRange(*keys).withColumn(RANGE, F.spark_partition_id()))


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Inclusive running sums of ``totals`` per group in ``order``.

    ``order`` must identify a row within its group.  Sums are exact for integers and decimals.
    """
    return _totals_in_ranges(into_ranges(df, [*groups, *order]), list(groups), list(order), totals)


def _totals_in_ranges(ranged: DataFrame, groups: list[str], order: list[str], totals: Mapping[str, Column]) -> DataFrame:
    # rows of one group inside one range: bounded by the size of a range
    local = Window.partitionBy(RANGE, *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.select("*", *[F.sum(c).over(local).alias(f"_local_{n}") for n, c in totals.items()])
    # a group that continues from earlier ranges needs a carry; each range has at most one such group, so the
    # filtered table is bounded by the number of ranges and safe to broadcast
    earlier = Window.partitionBy(*groups).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ranged.groupBy(RANGE, *groups)
        .agg(*[F.sum(c).alias(f"_part_{n}") for n, c in totals.items()])
        .select(RANGE, *groups, *[F.sum(f"_part_{n}").over(earlier).alias(f"_carry_{n}") for n in totals],
                F.count("*").over(earlier).alias("_earlier"))
        .filter(F.col("_earlier") > 0)
        .drop("_earlier")
    )
    joined = join_null_safe(rows, F.broadcast(carry), [RANGE, *groups])
    helpers = [RANGE] + [f"{p}{n}" for n in totals for p in ("_local_", "_carry_")]
    return joined.withColumns(
        {n: F.col(f"_local_{n}") + F.coalesce(F.col(f"_carry_{n}"), F.lit(0)) for n in totals}
    ).drop(*helpers)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    right = right.withColumnsRenamed({k: f"_r{k}" for k in keys})
    condition = None
    for k in keys:
        equal = left[k].eqNullSafe(right[f"_r{k}"])
        condition = equal if condition is None else condition & equal
    return left.join(right, condition, "left").drop(*[f"_r{k}" for k in keys])


def number_rows(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    position: str = "rn",
    size: str | None = None,
) -> DataFrame:
    """1-based position of every row in its group, and optionally the group size.

    The size table has one row per group; the join is left to the adaptive planner, which broadcasts it when its
    measured size is small and splits a hot group otherwise.
    """
    ranged = into_ranges(df, [*groups, *order])
    numbered = _totals_in_ranges(ranged, list(groups), list(order), {position: F.lit(1).cast("long")})
    if size is None:
        return numbered
    sizes = ranged.groupBy(*groups).agg(F.count("*").alias(size))
    return join_null_safe(numbered, sizes, groups)


def positional_values(
    df: DataFrame,
    name: str,
    value: str,
    fractions: Sequence[float],
) -> dict[str, dict[float, float]]:
    """Exact interpolated quantiles of ``value`` for every ``name``.

    Equal values are counted first, then located through running totals: no group is sorted in one task.  What
    reaches the driver is two rows per name and fraction.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(name, value).agg(F.count("*").alias("_n"))
    located = running_totals(counted, [name], [value], {"_upto": F.col("_n")})
    sizes = {r[0]: r[1] for r in located.groupBy(name).agg(F.max("_upto")).collect()}
    wanted = {}
    for key, n in sizes.items():
        for f in fractions:
            at = f * (n - 1)
            low = int(at)
            wanted[key, f] = (low, min(low + 1, n - 1), at - low)
    spots = sorted({(k, p) for (k, _), (lo, hi, _) in wanted.items() for p in (lo, hi)}, key=str)
    spark = df.sparkSession
    key_type = counted.schema[name].dataType.simpleString()
    targets = spark.createDataFrame(spots, f"`{name}` {key_type}, _pos long")  # two rows per name and fraction
    found = (
        located.join(F.broadcast(targets), name)
        .filter((F.col("_pos") >= F.col("_upto") - F.col("_n")) & (F.col("_pos") < F.col("_upto")))
        .select(name, "_pos", value)
        .collect()
    )
    at = {(r[0], r[1]): float(r[2]) for r in found}
    result: dict[str, dict[float, float]] = {}
    for (key, f), (lo, hi, part) in wanted.items():
        result.setdefault(key, {})[f] = at[key, lo] + (at[key, hi] - at[key, lo]) * part
    return result


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    """The first ``k`` rows per group.

    The filter on ``row_number`` lets Spark keep only ``k`` rows per group in every map task before the shuffle
    (WindowGroupLimit), so a hot group arrives as at most ``k`` rows per task.
    """
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
