import json

import pytest
from pyspark.sql import functions as F

from goldpan.operators import columns, dependencies, grouping
from goldpan.plans import etl
from goldpan.session import apply_settings, parse_setting, scratch_path
from goldpan.sources import catalog, lake, readers


def table_entry(name, deps, target, **extra):
    return {"table_name": name, "dependencies": deps,
            "transformations": {"add_columns": [{"name": "year", "expression": "year(day)"}, {"name": "next", "expression": "year + 1"}],
                                "sorting": ["k"], "repartition": 3},
            "destination": {"file_format": "parquet", "compression": "snappy", "partitionBy": ["year"], "mode": "overwrite", "path": f"{target}/{name}"}, **extra}


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = spark.range(200).select(F.col("id").alias("k"), F.expr("date_add(date'2023-12-01', cast(id % 60 as int))").alias("day"))
    for name in ("a", "b", "c"):
        rows.write.parquet(f"{path}/{name}")
    return path


def config_for(spark, source, target, tables):
    body = {"spark_settings": [], "source_connection": {"files": {"read_format": "parquet", "connection_string": source}}, "tables": tables}
    return catalog.pipeline_config(spark.createDataFrame([(json.dumps({"p": body}),)], "value string"), "p")


def test_pipeline_runs_in_order_and_reports(spark, source, tmp_path):
    out = str(tmp_path / "out")
    config = config_for(spark, source, out, {"a": table_entry("a", ["b", "c"], out), "b": table_entry("b", ["c"], out), "c": table_entry("c", [], out)})
    report = [(r["table"], r["level"], r["rows"], r["status"]) for r in etl.run_pipeline(spark, config).collect()]
    assert report == [("c", 0, 200, "ok"), ("b", 1, 200, "ok"), ("a", 2, 200, "ok")]
    written = spark.read.parquet(f"{out}/a")
    assert written.count() == 200 and {r[0] for r in written.select("year").distinct().collect()} == {2023, 2024}
    assert written.filter("next <> year + 1").count() == 0


def test_failed_table_skips_what_depends_on_it(spark, source, tmp_path):
    out = str(tmp_path / "out")
    config = config_for(spark, source, out, {"a": table_entry("a", ["gone"], out), "gone": table_entry("gone", [], out), "c": table_entry("c", [], out)})
    report = {r["table"]: r["status"] for r in etl.run_pipeline(spark, config).collect()}
    assert report == {"a": "skipped", "gone": "failed", "c": "ok"}


def test_levels_of_one_document_agree_with_the_catalog_form():
    def document(**deps):
        return {"tables": {name: {"dependencies": list(d)} for name, d in deps.items()}}

    assert etl.plan_levels(document(a="bc", b="c", c="", d="")) == [["c", "d"], ["b"], ["a"]]
    with pytest.raises(ValueError, match="cyclic.*a, b"):
        etl.plan_levels(document(a="b", b="a", c="a"))
    with pytest.raises(ValueError, match="missing.*a -> z"):
        etl.plan_levels(document(a="z"))


def test_written_files_are_sorted_and_a_hot_partition_is_spread(spark, tmp_path):
    path = str(tmp_path / "lake")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")  # parts are split by measured size, and these are small
    try:
        hot = spark.range(0, 5000, 1, 4).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 100 == 0, "cold").otherwise("hot").alias("part"))
        assert lake.write_lake(hot, {"file_format": "parquet", "partitionBy": ["part"], "mode": "overwrite", "path": path}, ["k"], 4) == 5000
        written = spark.read.parquet(path).withColumn("file", F.input_file_name())
        assert written.filter("part = 'hot'").select("file").distinct().count() > 1
        same = lake.arrange(hot.withColumn("k", F.lit(1)).withColumn("part", F.lit("x")), 4, ["part"], ["k"])
        same.write.parquet(f"{path}-same")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sizes = [r["count"] for r in spark.read.parquet(f"{path}-same").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 5000 and len(sizes) > 1  # a lake partition of equal keys is divided as well


def test_append_twice_doubles(spark, tmp_path):
    path = str(tmp_path / "lake")
    for _ in range(2):
        lake.write_lake(spark.range(10).withColumn("p", F.lit(1)), {"file_format": "parquet", "partitionBy": ["p"], "mode": "append", "path": path})
    assert spark.read.parquet(path).count() == 20


def graph(spark, tables, edges):
    return (spark.createDataFrame([("p", t) for t in tables], "pipeline string, table string"),
            spark.createDataFrame([("p", t, d) for t, d in edges], "pipeline string, table string, dep string"))


def test_levels_cycles_and_missing_dependencies(spark):
    levels = dependencies.dependency_levels(*graph(spark, "abcd", [("a", "b"), ("a", "c"), ("b", "c")]))
    assert {r["table"]: r["level"] for r in levels.collect()} == {"a": 2, "b": 1, "c": 0, "d": 0}
    with pytest.raises(ValueError, match="cyclic.*a, b, c"):
        dependencies.check_dependencies(*graph(spark, "abcd", [("a", "b"), ("b", "a"), ("c", "a")]))
    with pytest.raises(ValueError, match="missing.*a -> z"):
        dependencies.check_dependencies(*graph(spark, "ab", [("a", "z")]))


def test_settings_are_parsed_and_never_executed(spark):
    assert parse_setting("spark.conf.set('a.b', '1')") == ("a.b", "1")
    assert parse_setting("spark.sql.shuffle.partitions = 8") == ("spark.sql.shuffle.partitions", "8")
    with pytest.raises(ValueError, match="not a session setting"):
        parse_setting("__import__('os').system('true')")
    with pytest.raises(ValueError, match="fixed when the session starts"):
        apply_settings(spark, ["spark.sql.warehouse.dir = /x"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert apply_settings(spark, ["spark.conf.set('spark.sql.files.maxPartitionBytes', '64MB')"]) == {"spark.sql.files.maxPartitionBytes": "64MB"}
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_jdbc_options():
    connection = {"read_format": "jdbc", "port": 7001, "default_db": "[sales]",
                  "connection_string": "jdbc:sqlserver://{sql_host}:{conf['port']};database={conf['default_db']}"}
    table = {"schema": "sales", "table_name": "t", "query_parameters": {"numPartitions": 8, "partitionColumn": "id", "lowerBound": 1, "upperBound": 100, "fetchsize": 10}}
    options = readers.jdbc_options(connection, table, {"host": "h", "user": "u", "password": "s"})
    assert options == {"url": "jdbc:sqlserver://h:7001;database=sales", "dbtable": "sales.t", "numPartitions": "8", "partitionColumn": "id",
                       "lowerBound": "1", "upperBound": "100", "fetchsize": "10", "user": "u", "password": "s"}
    with pytest.raises(ValueError, match="needs partitionColumn"):
        readers.jdbc_options(connection, {**table, "query_parameters": {"partitionColumn": "id"}}, {"host": "h"})
    with pytest.raises(ValueError, match="no value for"):
        readers.jdbc_options(connection, table, {})


def test_connection_defaults_and_ambiguity(spark):
    def document(connections, named=None):
        body = {"spark_settings": ["a=b"], "source_connection": {c: {"read_format": "parquet"} for c in connections},
                "tables": {"t": {"source_connection": named, "table_name": "t", "destination": {"path": "x"}}}}
        return spark.createDataFrame([(json.dumps({"p": body}),)], "value string")

    assert catalog.pipeline_config(document(["one"]), "p")["tables"]["t"]["source_connection"] == "one"
    with pytest.raises(ValueError, match="names no connection"):
        catalog.pipeline_config(document(["one", "two"]), "p")
    with pytest.raises(ValueError, match="unknown connection"):
        catalog.pipeline_config(document(["one"], "other"), "p")
    with pytest.raises(ValueError, match="found 0 times"):
        catalog.pipeline_config(document(["one"]), "q")


def test_documents_from_files(spark, tmp_path):
    path = tmp_path / "conf.json"
    path.write_text('{"p": {\n "spark_settings": ["a=b", "nonsense"],\n "source_connection": {}, "tables": {}}}')
    rows = catalog.settings(catalog.parse_documents(catalog.read_documents(spark, str(path)))).orderBy("position").collect()
    assert [(r["key"], r["value"]) for r in rows] == [("a", "b"), (None, None)]


def test_csv_with_a_bad_number_fails(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a;b\n1;2.5\nx;1\n")
    with pytest.raises(Exception):
        readers.read_delimited(spark, str(path), ["a", "b"], ";").collect()


def test_group_counts_profile_and_task(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", None, 2), (None, 3, 3), ("b", None, None)], "g string, x int, y int")
    assert {r["g"]: (r["x"], r["y"]) for r in grouping.nonnull_counts(df, "g").collect()} == {"a": (1, 1), "b": (0, 0)}
    assert {r["column_name"]: r["non_null"] for r in grouping.profile(df).collect()} == {"g": 3, "x": 2, "y": 2}
    for n, task in ((2, "classification"), (3, "multiclass"), (10, "multiclass"), (11, "regression"), (5000, "regression")):
        assert grouping.detect_task(spark.range(n), "id").first()["task"] == task
    assert grouping.task_type(2) == "classification"


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="missing columns"):
        columns.select_renamed(spark.range(1), {"nope": "x"})
    assert columns.update_where(spark.range(3), "id", F.col("id") > 1, F.lit(0)).agg(F.sum("id")).first()[0] == 1


def test_scratch_folder_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/")
