"""Scalar building blocks shared by rules, marts and the stream."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(15,2)"


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.or_, conditions)


def whole_seconds(start: Column, end: Column) -> Column:
    """Second boundaries between two wall clocks (exact under a UTC session)."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double that gives NULL on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def row_fingerprint(names: Iterable[str]) -> Column:
    """MD5 over all values. Separator and NULL mark are fixed values of the identity format."""
    separator, null_mark = "\x1f", "\x00"
    texts = [F.coalesce(F.col(n).cast("string"), F.lit(null_mark)) for n in names]
    return F.md5(F.concat_ws(separator, *texts))


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters must not copy.

    A filter on a projected column is pushed below it with the whole expression in its place, once
    per use; planning time and run time grow with every copy. An explode of one element is where
    that stops.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
