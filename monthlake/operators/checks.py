"""Data tests: each returns the violations, so an empty frame means the test passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values held by more than one row. Counts combine before the shuffle."""
    present = df
    for c in columns:
        present = present.filter(F.col(c).isNotNull())
    return present.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their row counts; NULL is not a violation."""
    outside = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child values with no parent, with their row counts.

    Child rows are counted per value before the join, so a value that a third of the rows share
    crosses the network once per task, and no side is broadcast by hand.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    keys = parent.select(F.col(key).alias(column)).distinct()
    return values.join(keys, column, "left_anti")


def mart_reconciles(mart: DataFrame, fact: DataFrame) -> DataFrame:
    """Daily mart against fact: one sum beside the other, as a scalar subquery."""
    total = mart.agg(F.sum("trips")).scalar().alias("mart_trips")
    both = fact.agg(F.count(F.lit(1)).alias("fact_trips")).select(total, "fact_trips")
    return both.filter(F.col("mart_trips") != F.col("fact_trips"))


def fact_matches_staging(fact: DataFrame, staging: DataFrame) -> DataFrame:
    rows = staging.agg(F.count(F.lit(1))).scalar().alias("staging_trips")
    both = fact.agg(F.count(F.lit(1)).alias("fact_trips")).select("fact_trips", rows)
    return both.filter(F.col("fact_trips") != F.col("staging_trips"))


def dropoff_before_pickup(staging: DataFrame) -> DataFrame:
    return staging.filter(F.col("dropoff_datetime") < F.col("pickup_datetime")).select(
        "trip_id", "pickup_datetime", "dropoff_datetime"
    )


def recorded_above_total(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("trips_with_recorded_passengers") > F.col("trips")).select(
        "pickup_date", "trips", "trips_with_recorded_passengers"
    )
