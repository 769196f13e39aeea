"""Session set-up and the one place that decides where intermediate data is written."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
LOOP_ROWS = 20_000  # rows in a partition that a loop of passes reads
LOOP_PARTITIONS = 8  # fewer make no pass shorter

# a configured statement is either  key=value  or  spark.conf.set('key', 'value')
_SET_CALL = re.compile(r"""^\s*spark\.conf\.set\(\s*(['"])(?P<key>[^'"]+)\1\s*,\s*(['"])(?P<value>[^'"]*)\3\s*\)\s*$""")
_ASSIGNMENT = re.compile(r"^\s*(?P<key>[\w.\-]+)\s*=\s*(?P<value>.*?)\s*$")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may fall back to a folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured is None and not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    if configured is None:
        configured = tempfile.mkdtemp(prefix="goldpan-")
        spark.conf.set(CHECKPOINT_KEY, configured)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{scratch_root(spark).rstrip('/')}/goldpan/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and continue from there.

    Used where two branches must see the very same rows (range partition ids) and where a loop would let the
    lineage grow.  The files are reliable storage, so a lost executor costs a re-read and no re-computation.
    """
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def in_partitions(df: DataFrame, n: int) -> DataFrame:
    """``df`` in ``n`` partitions of equal size, without the sort of a plain ``repartition``."""
    return df.withColumn("_row", F.monotonically_increasing_id()).repartition(n, "_row").drop("_row")


def for_loops(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` of some ``rows`` rows dealt by ``keys`` for a loop of passes: at most as many partitions as a shuffle has, and no more than the
    cores and the rows need.  Every partition of every pass is a task, and one of a forest holds the statistics of all open nodes.
    """
    spark = df.sparkSession
    wanted = max(LOOP_PARTITIONS, spark.sparkContext.defaultParallelism, -(-rows // LOOP_ROWS))
    return df.repartition(min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted), *keys)


def parse_setting(statement: str) -> tuple[str, str]:
    """Key and value of a configured setting; anything else is refused, nothing is executed."""
    match = _SET_CALL.match(statement) or _ASSIGNMENT.match(statement)
    if match is None:
        raise ValueError(f"not a session setting: {statement!r}")
    return match.group("key"), match.group("value")


def apply_settings(spark: SparkSession, statements: list[str]) -> dict[str, str]:
    """Set the configured session options and return what was set."""
    applied = {}
    for key, value in map(parse_setting, statements):
        try:
            spark.conf.set(key, value)
        except AnalysisException as error:  # static keys are refused by the session itself
            raise ValueError(f"{key} is fixed when the session starts; pass it to spark-submit instead") from error
        applied[key] = value
    return applied
