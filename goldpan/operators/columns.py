"""Projections and predicates: derived, renamed, dropped and conditionally updated columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; available: {df.columns}")


def add_columns(df: DataFrame, specs: Sequence[Mapping[str, str]]) -> DataFrame:
    """Configured SQL-expression columns, in order: a later one may use an earlier one."""
    for spec in specs:
        df = df.withColumn(spec["name"], F.expr(spec["expression"]))
    return df


def select_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the columns in ``names`` (old -> new), in that order."""
    require_columns(df, list(names))
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    require_columns(df, names)
    return df.drop(*names)


def update_where(df: DataFrame, column: str, condition: Column, value: Column) -> DataFrame:
    """Replace ``column`` where the condition holds; a null condition leaves the row as it is."""
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def between_dates(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """History from ``start`` up to, not including, ``end``; the bounds reach the file scan."""
    kind = df.schema[column].dataType.simpleString()
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    return df.filter((F.col(column) >= low) & (F.col(column) < high))
