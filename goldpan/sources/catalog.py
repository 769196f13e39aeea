"""Pipeline documents as catalog tables: connections, tables, dependency edges, derived columns, settings.

A document is one JSON text ``{pipeline: {spark_settings, source_connection, tables}}``.  Documents are rows, so one
document or millions of them are flattened by the same narrow plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.session import parse_setting

CONNECTION = (
    "struct<source_type:string, read_format:string, azure_creds:struct<host:string, user:string, password:string>,"
    " port:int, default_db:string, connection_string:string>"
)
QUERY_PARAMETERS = "struct<numPartitions:int, partitionColumn:string, lowerBound:bigint, upperBound:bigint, fetchsize:int>"
TRANSFORMATIONS = "struct<add_columns:array<struct<name:string, expression:string>>, sorting:array<string>, repartition:int>"
DESTINATION = (
    "struct<storage:string, container:string, storage_account:string, file_format:string, compression:string,"
    " partitionBy:array<string>, mode:string, path:string>"
)
TABLE = (
    "struct<source_connection:string, schema:string, table_name:string, dependencies:array<string>,"
    f" query_parameters:{QUERY_PARAMETERS}, transformations:{TRANSFORMATIONS}, destination:{DESTINATION}>"
)
PIPELINE = f"struct<spark_settings:array<string>, source_connection:map<string,{CONNECTION}>, tables:map<string,{TABLE}>>"
DOCUMENT = f"map<string,{PIPELINE}>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: the whole text in ``value``."""
    return spark.read.text(path, wholetext=True)


def parse_documents(documents: DataFrame, text: str = "value") -> DataFrame:
    """One row per pipeline: its name and its typed body.  A text that is not such a document fails the query."""
    parsed = F.from_json(text, DOCUMENT, {"mode": "FAILFAST"})
    return documents.select(F.explode(parsed).alias("pipeline", "body"))


def connections(pipelines: DataFrame) -> DataFrame:
    return pipelines.select("pipeline", F.explode("body.source_connection").alias("connection", "c")).select(
        "pipeline", "connection", "c.*")


def tables(pipelines: DataFrame) -> DataFrame:
    """One row per table; without a named connection the only one of the pipeline is taken."""
    names = F.map_keys("body.source_connection")
    only = F.when(F.size(names) == 1, names[0])
    return pipelines.select("pipeline", only.alias("_only"), F.explode("body.tables").alias("table", "t")).select(
        "pipeline", "table", F.coalesce("t.source_connection", "_only").alias("connection"), "t.schema", "t.table_name",
        "t.dependencies", "t.query_parameters", "t.transformations", "t.destination")


def edges(table_rows: DataFrame) -> DataFrame:
    return table_rows.select("pipeline", "table", F.explode("dependencies").alias("dep"))


def derived_columns(table_rows: DataFrame) -> DataFrame:
    return table_rows.select("pipeline", "table", F.posexplode("transformations.add_columns").alias("position", "a")).select(
        "pipeline", "table", "position", "a.name", "a.expression")


def settings(pipelines: DataFrame) -> DataFrame:
    """Key and value of every configured session setting; a statement of another form has null in both."""
    statement = F.col("statement")
    call = r"^\s*spark\.conf\.set\(\s*['\"]([^'\"]+)['\"]\s*,\s*['\"]([^'\"]*)['\"]\s*\)\s*$"
    pair = r"^\s*([\w.\-]+)\s*=\s*(.*?)\s*$"

    def part(i: int):
        return F.when(statement.rlike(call), F.regexp_extract(statement, call, i)).when(
            statement.rlike(pair), F.regexp_extract(statement, pair, i))

    return pipelines.select("pipeline", F.posexplode("body.spark_settings").alias("position", "statement")).select(
        "pipeline", "position", part(1).alias("key"), part(2).alias("value"))


def with_connections(table_rows: DataFrame, connection_rows: DataFrame) -> DataFrame:
    """Left lookup of the connection of every table."""
    return table_rows.join(connection_rows, ["pipeline", "connection"], "left")


def pipeline_config(documents: DataFrame, pipeline: str, text: str = "value") -> Mapping:
    """One pipeline as a nested dictionary, for the driver that runs it.  Its size is that of its document."""
    rows = parse_documents(documents, text).filter(F.col("pipeline") == pipeline).select("body").limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"pipeline {pipeline!r} found {len(rows)} times")
    body = rows[0]["body"].asDict(recursive=True)
    for statement in body["spark_settings"] or []:
        parse_setting(statement)
    names = list(body["source_connection"] or {})
    for name, table in body["tables"].items():
        if table["source_connection"] is None:
            if len(names) != 1:
                raise ValueError(f"table {name!r} names no connection and the pipeline has {len(names)}")
            table["source_connection"] = names[0]
        if table["source_connection"] not in names:
            raise ValueError(f"table {name!r} uses the unknown connection {table['source_connection']!r}")
    return body
