"""Sinks: partitioned lake tables and CSV results."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASENAME = "mapreduce.output.basename"  # Hadoop's key for the beginning of the names of written files


def arrange(df: DataFrame, partitions: int | None, partition_by: Sequence[str], sorting: Sequence[str]) -> DataFrame:
    """Distribute for a partitioned write, then sort inside the tasks; the source is read once.

    Rows of a lake partition come together by hash.  The exchange is one that adaptive execution may rebalance by the sizes it has
    measured: a lake partition that holds most of the rows is split over several tasks, small ones share a task.
    """
    keys = [F.col(c) for c in dict.fromkeys([*partition_by, *sorting])]
    if partitions:
        df = df.hint("rebalance", partitions, *partition_by) if partition_by else df.repartition(partitions)
    return df.sortWithinPartitions(*keys) if keys else df


def written_rows(spark: SparkSession, file_format: str, path: str, basename: str) -> int:
    """Rows in the files of one write, told by their names; other files are not opened, columnar ones are counted by their footers."""
    stored = spark.read.format(file_format).load(path)
    return stored.where(F.col("_metadata.file_name").startswith(basename)).count()


def write_lake(df: DataFrame, destination: Mapping, sorting: Sequence[str] = (), partitions: int | None = None) -> int:
    """Write as configured (format, mode, compression, partition columns) and return how many rows this write has committed.

    The files of a write carry a name of their own, so what other writers add at the same time is not counted.  An observed metric would
    need no second look, but a session that has used one can no longer ship Spark ML models with training summaries to its tasks.
    """
    partition_by = destination.get("partitionBy") or []
    file_format, path = destination["file_format"], destination["path"]
    mode = destination.get("mode") or "errorifexists"
    basename = f"part-{uuid.uuid4().hex}"
    writer = arrange(df, partitions, partition_by, sorting).write.format(file_format).mode(mode).option(BASENAME, basename)
    if destination.get("compression"):
        writer = writer.option("compression", destination["compression"])
    writer.partitionBy(*partition_by).save(path)
    # an empty write leaves nothing from which a format without a schema of its own could be read
    return 0 if df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"{basename}*").load(
        path).select("path").isEmpty() else written_rows(df.sparkSession, file_format, path, basename)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with a header line per file and no index column."""
    df.write.mode("overwrite").csv(path, sep=sep, header=True)
