"""Tables written to the cluster's shared folder, and blocks of bounded size for broadcasting."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from goldpan.session import scratch_path

RELEASE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Actions inside remove their shuffle files when they end; what they return or write does not need them any more."""
    before = spark.conf.get(RELEASE_KEY, None)
    spark.conf.set(RELEASE_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE_KEY)
        else:
            spark.conf.set(RELEASE_KEY, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and continue from the files.

    Cuts the lineage and is read as often as needed; a lost executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    with releasing(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
