"""Run configured tables: read, derive, arrange, write, in dependency order."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from graphlib import CycleError, TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.operators.columns import add_columns
from goldpan.session import apply_settings
from goldpan.sources.lake import write_lake
from goldpan.sources.readers import read_table

PARALLEL_TABLES = 4  # tables whose jobs are submitted at the same time
REPORT = "table string, level int, rows long, path string, status string, message string"


def transform(df: DataFrame, transformations: Mapping | None) -> DataFrame:
    return add_columns(df, (transformations or {}).get("add_columns") or [])


def process_table(spark: SparkSession, table: Mapping, connection: Mapping, credentials: Mapping[str, str]) -> int:
    """Read one table, add its derived columns, write it; returns the number of rows."""
    steps = table.get("transformations") or {}
    df = transform(read_table(spark, connection, table, credentials), steps)
    return write_lake(df, table["destination"], steps.get("sorting") or [], steps.get("repartition"))


def plan_levels(config: Mapping) -> list[list[str]]:
    """Table names per dependency level of one document; missing and cyclic dependencies raise.

    One document is a handful of names that are already here, so no Spark job is spent on it.  Catalogs of many
    documents are leveled as tables by ``operators.dependencies``.
    """
    waits = {name: set(table.get("dependencies") or []) for name, table in config["tables"].items()}
    missing = sorted(f"{name} -> {dep}" for name, deps in waits.items() for dep in deps if dep not in waits)
    if missing:
        raise ValueError(f"missing dependencies: {', '.join(missing)}")
    order = TopologicalSorter(waits)
    try:
        order.prepare()
    except CycleError as error:
        raise ValueError(f"cyclic dependencies among: {', '.join(sorted(set(error.args[1])))}") from error
    levels = []
    while order.is_active():
        ready = order.get_ready()
        levels.append(sorted(ready))
        order.done(*ready)
    return levels


def run_pipeline(spark: SparkSession, config: Mapping, credentials: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """Process all tables of a pipeline and report per table.

    A failing table is reported and everything that depends on it is skipped; independent tables go on.
    ``credentials`` maps a connection name to host, user and password.
    """
    apply_settings(spark, config.get("spark_settings") or [])
    credentials = credentials or {}
    report: dict[str, tuple] = {}

    def run(name: str, level: int) -> tuple:
        table = config["tables"][name]
        path = table["destination"]["path"]
        bad = [d for d in table.get("dependencies") or [] if report[d][4] != "ok"]
        if bad:
            return name, level, None, path, "skipped", f"waits for {', '.join(sorted(bad))}"
        source = table["source_connection"]
        try:
            rows = process_table(spark, table, config["source_connection"][source], credentials.get(source, {}))
            return name, level, rows, path, "ok", None
        except Exception as error:  # reported, and the tables behind it are skipped
            return name, level, None, path, "failed", f"{type(error).__name__}: {str(error).splitlines()[0]}"

    levels = {name: level for level, names in enumerate(plan_levels(config)) for name in names}
    work = inheritable_thread_target(spark)(run)
    order = TopologicalSorter({name: set(table.get("dependencies") or []) for name, table in config["tables"].items()})
    order.prepare()
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        while order.is_active():
            # a table starts as soon as the last of its own inputs has ended, whatever else is still running
            running |= {pool.submit(work, name, levels[name]): name for name in sorted(order.get_ready())}
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in ended:
                report[running[future]] = future.result()
                order.done(running.pop(future))
    return spark.createDataFrame(list(report.values()), REPORT).orderBy("level", F.col("table"))
