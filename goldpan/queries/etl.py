"""Sources, sinks, catalogs, dependency order and whole pipelines."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.operators import columns, dependencies, grouping
from goldpan.plans import etl
from goldpan.queries.registry import query, table
from goldpan.session import scratch_path
from goldpan.sources import catalog, lake, readers


def part_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One pipeline document per part: three tables, the first waits for the other two, the second for the third.

    Every second part names its connection only in the first table, as configurations often do.
    """
    key = F.col("p_partkey").cast("string")
    null = F.lit(None).cast("string")

    def entry(number: int, deps: list[int], named):
        return F.struct(
            named.alias("source_connection"), F.col("p_brand").alias("schema"),
            F.concat(F.lower("p_type"), F.lit(f"_{number}")).alias("table_name"),
            F.array(*[F.lit(f"table_{d}") for d in deps]).cast("array<string>").alias("dependencies"),
            F.struct((F.col("p_size") + number).alias("numPartitions"), F.lit("id").alias("partitionColumn"),
                     F.lit(1).alias("lowerBound"), (F.col("p_partkey") + 1000).alias("upperBound"),
                     (F.col("p_size") * 100).alias("fetchsize")).alias("query_parameters"),
            F.struct(F.array(F.struct(F.lit("year").alias("name"), F.lit("year(date)").alias("expression")),
                             F.struct(F.lit("month").alias("name"), F.lit("month(date)").alias("expression"))).alias("add_columns"),
                     F.array(F.lit("date")).alias("sorting"), F.lit(4 * number).alias("repartition")).alias("transformations"),
            F.struct(F.lit("parquet").alias("file_format"), F.array(F.lit("year"), F.lit("month")).alias("partitionBy"),
                     F.lit("overwrite").alias("mode"), F.concat(F.lit("/lake/"), key, F.lit(f"/{number}")).alias("path")).alias("destination"))

    connection = F.concat(F.lit("source_"), F.col("p_brand"))
    later = F.when(F.col("p_partkey") % 2 == 0, connection).otherwise(null)
    tables = F.create_map(F.lit("table_1"), entry(1, [2, 3], connection), F.lit("table_2"), entry(2, [3], later),
                          F.lit("table_3"), entry(3, [], later))
    body = F.struct(
        F.array(F.concat(F.lit("spark.conf.set('spark.sql.files.maxPartitionBytes', '"), F.col("p_size"), F.lit("MB')")),
                F.lit("spark.sql.shuffle.partitions = 64")).alias("spark_settings"),
        F.create_map(connection, F.struct(F.lit("jdbc").alias("read_format"), (7000 + F.col("p_size")).alias("port"),
                                          F.lower("p_brand").alias("default_db"))).alias("source_connection"),
        tables.alias("tables"))
    return table(spark, folder, "part").select(F.to_json(F.create_map(F.concat(F.lit("pipeline_"), key), body)).alias("value"))


def part_pipelines(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.parse_documents(part_documents(spark, folder))


@query("q_config_catalog", """
    SELECT 'pipeline_' || p_partkey AS pipeline, 'table_' || n AS "table", 'source_' || p_brand AS connection,
           lower(p_type) || '_' || n AS table_name, CAST(p_size + n AS INTEGER) AS partitions, p_partkey + 1000 AS upper_bound,
           CAST(CASE n WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS INTEGER) AS n_dependencies,
           'year=year(date), month=month(date)' AS derived, '/lake/' || p_partkey || '/' || n AS path
    FROM part, (VALUES (1), (2), (3)) v(n)""")
def config_catalog(spark, folder):
    rows = catalog.tables(part_pipelines(spark, folder))
    derived = F.concat_ws(", ", F.transform("transformations.add_columns", lambda a: F.concat(a["name"], F.lit("="), a["expression"])))
    return rows.select("pipeline", "table", "connection", "table_name", F.col("query_parameters.numPartitions").alias("partitions"),
                       F.col("query_parameters.upperBound").alias("upper_bound"), F.size("dependencies").alias("n_dependencies"),
                       derived.alias("derived"), F.col("destination.path").alias("path"))


@query("q_settings", """
    SELECT 'pipeline_' || p_partkey AS pipeline, 'spark.sql.files.maxPartitionBytes' AS key, p_size || 'MB' AS value FROM part
    UNION ALL SELECT 'pipeline_' || p_partkey, 'spark.sql.shuffle.partitions', '64' FROM part""")
def settings(spark, folder):
    return catalog.settings(part_pipelines(spark, folder)).select("pipeline", "key", "value")


@query("q_connection_lookup", """
    SELECT 'pipeline_' || p_partkey AS pipeline, 'table_' || n AS "table", 'source_' || p_brand AS connection, 'jdbc' AS read_format,
           CAST(7000 + p_size AS INTEGER) AS port
    FROM part, (VALUES (1), (2), (3)) v(n)""")
def connection_lookup(spark, folder):
    pipelines = part_pipelines(spark, folder)
    found = catalog.with_connections(catalog.tables(pipelines), catalog.connections(pipelines))
    return found.select("pipeline", "table", "connection", "read_format", "port")


@query("q_derived_columns", """
    SELECT 'pipeline_' || p_partkey AS pipeline, 'table_' || n AS "table", CAST(m.i AS INTEGER) AS position, m.name, m.expression
    FROM part, (VALUES (1), (2), (3)) v(n), (VALUES (0, 'year', 'year(date)'), (1, 'month', 'month(date)')) m(i, name, expression)""")
def derived_columns(spark, folder):
    return catalog.derived_columns(catalog.tables(part_pipelines(spark, folder)))


# suppliers as tables of one pipeline per nation: supplier s waits for s / 2 and s / 3 in the same nation where they exist
_SUPPLIER_EDGES = """
    SELECT a.s_nationkey AS pipeline, a.s_suppkey AS t, b.s_suppkey AS dep
    FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey > b.s_suppkey
     AND (b.s_suppkey = a.s_suppkey // 2 OR b.s_suppkey = a.s_suppkey - 25 OR b.s_suppkey = a.s_suppkey // 3)"""


def supplier_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    suppliers = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("pipeline"), F.col("s_suppkey").alias("table"))
    wishes = F.array(F.expr("`table` div 2"), F.col("table") - 25, F.expr("`table` div 3"))
    wanted = suppliers.select("*", F.explode(F.array_distinct(wishes)).alias("dep")).filter(F.col("dep") < F.col("table"))
    known = suppliers.withColumnRenamed("table", "dep")
    return suppliers, wanted.join(known, ["pipeline", "dep"], "left_semi").select("pipeline", "table", "dep")


@query("q_dependency_levels", f"""
    WITH RECURSIVE edges AS ({_SUPPLIER_EDGES}),
    walk(pipeline, t, level) AS (
        SELECT s_nationkey, s_suppkey, 0 FROM supplier
        UNION SELECT e.pipeline, e.t, w.level + 1 FROM walk w JOIN edges e ON e.pipeline = w.pipeline AND e.dep = w.t)
    SELECT pipeline, t AS "table", CAST(max(level) AS INTEGER) AS level FROM walk GROUP BY ALL""")
def dependency_levels(spark, folder):
    return dependencies.dependency_levels(*supplier_graph(spark, folder))


@query("q_missing_dependencies", """
    SELECT a.s_nationkey AS pipeline, a.s_suppkey AS "table", a.s_suppkey // 2 AS dep FROM supplier a
    WHERE a.s_suppkey > 0 AND NOT EXISTS (SELECT 1 FROM supplier b WHERE b.s_nationkey = a.s_nationkey AND b.s_suppkey = a.s_suppkey // 2)""")
def missing_dependencies(spark, folder):
    suppliers, _ = supplier_graph(spark, folder)
    wanted = suppliers.filter(F.col("table") > 0).withColumn("dep", F.expr("`table` div 2"))
    return dependencies.missing_dependencies(suppliers, wanted).select("pipeline", "table", "dep")


@query("q_json_read", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_read(spark, folder):
    return readers.expand_json(table(spark, folder, "events").select("event_id", "props"), "props", "k long").select("event_id", "k")


@query("q_json_records", """
    SELECT event_type AS category, CAST(count(*) AS BIGINT) AS n, CAST(max(year(ts)) AS INTEGER) AS last_year FROM events GROUP BY event_type""")
def json_records(spark, folder):
    path = scratch_path(spark, "json")
    table(spark, folder, "events").select(F.col("ts").alias("date"), F.col("event_type").alias("category"), "value").write.json(path)
    records = readers.read_json(spark, path, "date timestamp_ntz, category string, value double")
    return records.groupBy("category").agg(F.count("*").alias("n"), F.max(F.year("date")).alias("last_year"))


@query("q_csv_roundtrip", """
    SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def csv_roundtrip(spark, folder):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    path = scratch_path(spark, "csv")
    lake.write_csv(table(spark, folder, "lineitem").select(*names), path, sep=";")
    return readers.read_delimited(spark, path, names, sep=";")


@query("q_labeled_dataset", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice AS "Target" FROM lineitem""")
def labeled_dataset(spark, folder):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return readers.labeled(table(spark, folder, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", keys=keys)


@query("q_profile", """
    SELECT column_name, data_type, CAST(n AS BIGINT) AS non_null, CAST((SELECT count(*) FROM events) AS BIGINT) AS row_count FROM (
        SELECT 'event_id' AS column_name, 'bigint' AS data_type, (SELECT count(event_id) FROM events) AS n
        UNION ALL SELECT 'ts', 'timestamp_ntz', (SELECT count(ts) FROM events)
        UNION ALL SELECT 'user_id', 'bigint', (SELECT count(user_id) FROM events)
        UNION ALL SELECT 'event_type', 'string', (SELECT count(event_type) FROM events)
        UNION ALL SELECT 'value', 'double', (SELECT count(value) FROM events)
        UNION ALL SELECT 'props', 'string', (SELECT count(props) FROM events))""")
def table_profile(spark, folder):
    return grouping.profile(table(spark, folder, "events"))


def _orders_lake(spark: SparkSession, folder: str, mode: str, path: str) -> int:
    orders = columns.add_columns(table(spark, folder, "orders"), [
        {"name": "year", "expression": "year(o_orderdate)"}, {"name": "month", "expression": "month(o_orderdate)"}])
    destination = {"file_format": "parquet", "compression": "gzip", "partitionBy": ["year", "month"], "mode": mode, "path": path}
    return lake.write_lake(orders, destination, ["o_custkey", "o_orderdate"], 8)


_MONTHS = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST({times} * count(*) AS BIGINT) AS n,
           CAST({times} * sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders GROUP BY 1, 2"""


def _months(df: DataFrame) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return df.groupBy("year", "month").agg(F.count("*").alias("n"), F.sum(cents).alias("cents"))


@query("q_lake_write_overwrite", _MONTHS.format(times=1))
def lake_write_overwrite(spark, folder):
    path = scratch_path(spark, "lake")
    for _ in range(2):
        _orders_lake(spark, folder, "overwrite", path)
    return _months(spark.read.parquet(path))


@query("q_lake_write_append", _MONTHS.format(times=2))
def lake_write_append(spark, folder):
    path = scratch_path(spark, "lake")
    for _ in range(2):
        _orders_lake(spark, folder, "append", path)
    return _months(spark.read.parquet(path))


def warehouse_document(folder: str, target: str) -> str:
    """A document that reads three of the given tables from files; the first table waits for the other two."""

    def entry(name: str, key: str, date: str, deps: list[str], sorting: list[str], partitions: int) -> dict:
        return {
            "source_connection": "warehouse", "schema": None, "table_name": f"{name}.parquet", "dependencies": deps,
            "query_parameters": {"numPartitions": 6, "partitionColumn": key, "lowerBound": 0, "upperBound": 60000, "fetchsize": 2500},
            "transformations": {
                "add_columns": [{"name": "year", "expression": f"year({date})"}, {"name": "month", "expression": f"month({date})"},
                                {"name": "quarter_start", "expression": "3 * cast((month - 1) / 3 as int) + 1"}],
                "sorting": sorting, "repartition": partitions},
            "destination": {"file_format": "parquet", "compression": "snappy", "partitionBy": ["year", "month"],
                            "mode": "overwrite", "path": f"{target}/{name}"}}

    body = {
        "spark_settings": ["spark.conf.set('spark.sql.files.maxPartitionBytes', '96MB')"],
        "source_connection": {"warehouse": {"source_type": "files", "read_format": "parquet", "connection_string": folder}},
        "tables": {
            "orders": entry("orders", "o_orderkey", "o_orderdate", ["events", "lineitem"], ["o_custkey", "o_orderdate"], 12),
            "events": entry("events", "event_id", "ts", ["lineitem"], ["user_id", "ts"], 6),
            "lineitem": entry("lineitem", "l_orderkey", "l_shipdate", [], ["l_suppkey", "l_shipdate"], 18)}}
    return json.dumps({"warehouse": body})


def warehouse_config(spark: SparkSession, folder: str, target: str) -> dict:
    documents = spark.createDataFrame([(warehouse_document(folder, target),)], "value string")
    return catalog.pipeline_config(documents, "warehouse")


@query("q_etl_table", """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(3 * ((month(o_orderdate) - 1) // 3) + 1 AS INTEGER) AS quarter_start
    FROM orders""")
def etl_table(spark, folder):
    config = warehouse_config(spark, folder, scratch_path(spark, "etl"))
    entry = config["tables"]["orders"]
    etl.process_table(spark, entry, config["source_connection"]["warehouse"], {})
    written = spark.read.parquet(entry["destination"]["path"])
    return written.select("o_orderkey", "o_custkey", "o_totalprice", "year", "month", "quarter_start")


@query("q_etl_report", """
    SELECT 'lineitem' AS "table", 0 AS level, CAST(count(*) AS BIGINT) AS rows, 'ok' AS status FROM lineitem
    UNION ALL SELECT 'events', 1, count(*), 'ok' FROM events
    UNION ALL SELECT 'orders', 2, count(*), 'ok' FROM orders""")
def etl_report(spark, folder):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        report = etl.run_pipeline(spark, warehouse_config(spark, folder, scratch_path(spark, "etl")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return report.select("table", "level", "rows", "status")
