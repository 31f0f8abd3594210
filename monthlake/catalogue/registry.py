"""Registered queries: a Spark callable each, with the same result in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthlake.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def plain_types(df: DataFrame) -> DataFrame:
    """bigint, double, boolean and string only, so both engines show equal values.

    Applied to registered queries alone; the library returns dates, decimals and arrays.
    """

    def plain(field: T.StructField):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
            return column.cast("string").alias(field.name)
        if isinstance(kind, T.DecimalType | T.FloatType):
            return column.cast("double").alias(field.name)
        if isinstance(kind, T.ByteType | T.ShortType | T.IntegerType):
            return column.cast("bigint").alias(field.name)
        if isinstance(kind, T.ArrayType):
            return F.array_join(column.cast("array<string>"), ",").alias(field.name)
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: plain_types(fn(configure(spark), sf_dir))
        if sql:
            SQL[name] = sql
        return fn

    return register


def text(*names: str) -> str:
    """SQL items that show dates and timestamps as text."""
    return ", ".join(f"cast({n} as varchar) as {n}" for n in names)


def number(*names: str) -> str:
    """SQL items that show decimals as doubles."""
    return ", ".join(f"cast({n} as double) as {n}" for n in names)
