"""Lake writes: one read of the source, rows of this write alone, hot lake partitions, dependents that start early."""

import glob
import threading

import pytest
from pyspark.sql import functions as F

from goldpan.plans import etl
from goldpan.sources import lake


def destination(path, mode="overwrite", by=("k",)):
    return {"file_format": "parquet", "path": str(path), "mode": mode, "partitionBy": list(by)}


@pytest.mark.parametrize("by", [("k",), ()])
def test_the_source_is_read_once(spark, tmp_path, by):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(5000).select("id", (F.col("id") % 3).alias("k")).mapInPandas(counted, "id long, k long")
    assert lake.write_lake(df, destination(tmp_path / "t", by=by), ["id"], 4) == 5000
    assert seen.value == 5000
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5000


def test_rows_of_other_writers_are_not_counted(spark, tmp_path, monkeypatch):
    path = tmp_path / "t"
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    count = lake.written_rows

    def after_another_writer(session, file_format, where, basename):
        df.write.mode("append").partitionBy("k").parquet(str(path))
        return count(session, file_format, where, basename)

    monkeypatch.setattr(lake, "written_rows", after_another_writer)
    for mode, n in (("append", 100), ("append", 70), ("overwrite", 40)):
        assert lake.write_lake(df.limit(n), destination(path, mode), ["id"], 2) == n
    assert spark.read.parquet(str(path)).count() == 140
    assert lake.write_lake(df.limit(0), destination(tmp_path / "none"), ["id"], 2) == 0
    assert lake.write_lake(df.limit(0), destination(tmp_path / "plain", by=()), [], None) == 0


def test_a_hot_lake_partition_is_split_and_rows_are_sorted(spark, tmp_path):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(F.lit(0))
        df = spark.range(0, 60_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), hot.alias("k"))
        lake.write_lake(df, destination(tmp_path / "t"), ["id"], 8)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = glob.glob(f"{tmp_path}/t/k=0/*.parquet")
    assert len(files) > 1
    for f in files:
        ids = [r[0] for r in spark.read.parquet(f).select("id").collect()]
        assert ids == sorted(ids)


def test_a_table_starts_when_its_own_inputs_have_ended(spark, monkeypatch):
    ended, c_ended = [], threading.Event()

    def process(session, table, connection, credentials):
        if table["name"] == "slow":
            assert c_ended.wait(60)  # would wait for ever behind a barrier per level
        ended.append(table["name"])
        if table["name"] == "c":
            c_ended.set()
        return 1

    def table(name, *needs):
        return {"name": name, "source_connection": "s", "dependencies": list(needs), "destination": {"path": name}}

    monkeypatch.setattr(etl, "process_table", process)
    tables = {"slow": table("slow"), "b": table("b"), "c": table("c", "b"), "d": table("d", "c", "slow")}
    report = etl.run_pipeline(spark, {"tables": tables, "source_connection": {"s": {}}}).collect()
    assert [(r["table"], r["level"], r["status"]) for r in report] == [("b", 0, "ok"), ("slow", 0, "ok"), ("c", 1, "ok"), ("d", 2, "ok")]
    assert ended == ["b", "c", "slow", "d"]
