"""Readers for the configured sources and for plain files."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from goldpan.operators.columns import require_columns

# {sql_host} or {anything['port']}: the last word names the value
_PLACEHOLDER = re.compile(r"\{(?:\w+\[['\"])?(\w+)(?:['\"]\])?\}")
_JDBC_PARAMETERS = ("numPartitions", "partitionColumn", "lowerBound", "upperBound", "fetchsize")


def fill_template(template: str, values: Mapping[str, object]) -> str:
    def value(match: re.Match) -> str:
        name = match.group(1)
        if values.get(name) is None:
            raise ValueError(f"no value for {{{name}}} in {template!r}")
        return str(values[name])

    return _PLACEHOLDER.sub(value, template)


def connection_url(connection: Mapping, credentials: Mapping[str, str]) -> str:
    database = (connection.get("default_db") or "").strip("[]") or None
    values = {"port": connection.get("port"), "default_db": database, "sql_host": credentials.get("host"), **credentials}
    return fill_template(connection["connection_string"], values)


def jdbc_options(connection: Mapping, table: Mapping, credentials: Mapping[str, str]) -> dict[str, str]:
    """Options of a partitioned JDBC read.  The bounds only set the stride: rows outside them are read as well."""
    qualified = ".".join(p for p in (table.get("schema"), table["table_name"]) if p)
    options = {"url": connection_url(connection, credentials), "dbtable": qualified}
    given = table.get("query_parameters") or {}
    options |= {k: str(given[k]) for k in _JDBC_PARAMETERS if given.get(k) is not None}
    split = [k for k in ("partitionColumn", "lowerBound", "upperBound") if k in options]
    if split and (len(split) < 3 or "numPartitions" not in options):
        raise ValueError(f"a partitioned read of {qualified} needs partitionColumn, both bounds and numPartitions")
    return options | {k: credentials[k] for k in ("user", "password", "driver") if k in credentials}


def read_table(spark: SparkSession, connection: Mapping, table: Mapping, credentials: Mapping[str, str]) -> DataFrame:
    """The source of a configured table.  File formats read ``<connection string>/<table name>``."""
    kind = connection["read_format"]
    if kind == "jdbc":
        return spark.read.format(kind).options(**jdbc_options(connection, table, credentials)).load()
    return spark.read.format(kind).load(f"{connection_url(connection, credentials).rstrip('/')}/{table['table_name']}")


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON records; with a schema the files are read once, without one they are read twice."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def expand_json(df: DataFrame, text: str, fields: str) -> DataFrame:
    """Typed fields of a JSON text column, given as a schema string."""
    return df.withColumn("_j", F.from_json(text, fields)).select("*", "_j.*").drop("_j")


def double_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, DoubleType()) for c in columns])


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited file with a header whose columns are all 64-bit floats; a bad value fails the query."""
    return spark.read.csv(path, sep=sep, header=True, schema=double_schema(columns), mode="FAILFAST", enforceSchema=False)


def labeled(df: DataFrame, features: Sequence[str | Column], target: str, name: str = "Target", keys: Sequence[str] = ()) -> DataFrame:
    """Feature columns as doubles plus the target under the configured name."""
    plain = [f for f in features if isinstance(f, str)]
    require_columns(df, [*plain, target, *keys])
    columns = [F.col(f).cast("double").alias(f) if isinstance(f, str) else f for f in features]
    return df.select(*keys, *columns, F.col(target).cast("double").alias(name))
