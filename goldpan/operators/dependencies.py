"""Dependency levels of tables: who can run first, who waits, who can never run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.session import materialize


def missing_dependencies(tables: DataFrame, edges: DataFrame, scope: Sequence[str] = ("pipeline",)) -> DataFrame:
    """Edges whose dependency is not a table of the same pipeline."""
    known = tables.select(*scope, F.col("table").alias("dep"))
    return edges.join(known, [*scope, "dep"], "left_anti")


def dependency_levels(tables: DataFrame, edges: DataFrame, scope: Sequence[str] = ("pipeline",)) -> DataFrame:
    """Adds ``level``: 0 without dependencies, otherwise one above the highest dependency.

    Each round settles every table whose dependencies are settled.  Tables in or behind a cycle, or behind a missing
    dependency, keep a null level.  All pipelines advance together, so the rounds follow the longest chain and not
    the number of pipelines; state between rounds is written to the checkpoint folder.
    """
    scope = list(scope)
    names = tables.select(*scope, "table")
    waiting = materialize(edges.select(*scope, "table", "dep").distinct())
    ready = materialize(names.join(waiting.select(*scope, "table").distinct(), [*scope, "table"], "left_anti"))
    settled = None
    level = 0
    while not ready.isEmpty():
        leveled = ready.withColumn("level", F.lit(level))
        settled = leveled if settled is None else settled.unionByName(leveled)
        done = ready.withColumnRenamed("table", "dep")
        released = waiting.join(done, [*scope, "dep"], "left_semi").select(*scope, "table").distinct()
        waiting = materialize(waiting.join(done, [*scope, "dep"], "left_anti"))
        ready = materialize(released.join(waiting, [*scope, "table"], "left_anti"))
        level += 1
    if settled is None:
        return names.withColumn("level", F.lit(None).cast("int"))
    return names.join(settled, [*scope, "table"], "left")


def check_dependencies(tables: DataFrame, edges: DataFrame) -> DataFrame:
    """Levels of all tables; raises when a dependency is missing or tables wait for each other."""
    missing = missing_dependencies(tables, edges)
    first = missing.limit(20).collect()  # only for the message
    if first:
        raise ValueError("missing dependencies: " + ", ".join(f"{r['table']} -> {r['dep']}" for r in first))
    levels = dependency_levels(tables, edges)
    stuck = levels.filter(F.col("level").isNull()).limit(20).collect()
    if stuck:
        raise ValueError("cyclic dependencies among: " + ", ".join(sorted(r["table"] for r in stuck)))
    return levels
