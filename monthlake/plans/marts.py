"""Marts over the fact: plain grouped aggregates, combined before each shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.functions.columns import ratio
from monthlake.functions.months import Month, month_start
from monthlake.plans.joins import dimension
from monthlake.plans.star import CARD
from monthlake.sources import fs, lake

# Miles are summed as decimals, so totals do not depend on the order of tasks. Each is rounded to twelve places
# first, which holds every digit a distance in miles is written with.
EXACT_MILES = "decimal(38,12)"
# Columns of the fact that the daily mart reads.
DAILY_READS = (
    "pickup_date", "has_quality_flag", "passenger_count", "payment_type", "trip_distance_miles", "fare_amount",
    "tip_amount", "total_amount",
)


def _count():
    return F.count(F.lit(1)).alias("trips")


def _miles():
    return F.sum(F.col("trip_distance_miles").cast(EXACT_MILES)).cast("double")



def daily_metrics(fact: DataFrame) -> DataFrame:
    recorded = F.count("passenger_count")
    passengers = F.sum("passenger_count")
    card = F.col("payment_type") == CARD

    def on_card(amount: str):
        return F.sum(F.when(card, F.col(amount)).otherwise(0))

    return fact.groupBy("pickup_date").agg(
        _count(),
        F.count_if("has_quality_flag").alias("flagged_trips"),
        recorded.alias("trips_with_recorded_passengers"),
        passengers.alias("recorded_passengers"),
        ratio(passengers, recorded).alias("avg_passengers_per_recorded_trip"),
        _miles().alias("trip_distance_miles"),
        *[F.sum(c).alias(c) for c in ("fare_amount", "tip_amount", "total_amount")],
        ratio(on_card("tip_amount"), on_card("fare_amount")).alias("card_tip_rate"),
    )


def hourly_demand(fact: DataFrame) -> DataFrame:
    seconds = F.sum("trip_duration_seconds")
    hours = ratio(seconds, F.lit(3600))
    return fact.groupBy("pickup_date", "pickup_hour").agg(
        _count(),
        F.sum("total_amount").alias("total_amount"),
        ratio(seconds, F.count("trip_duration_seconds")).alias("avg_duration_seconds"),
        ratio(_miles(), hours).alias("avg_speed_mph"),
    )


def zone_flows(fact: DataFrame) -> DataFrame:
    return fact.groupBy(
        month_start(F.col("pickup_date")).alias("month_start"), "pu_location_id", "do_location_id"
    ).agg(
        _count(),
        F.sum("total_amount").alias("total_amount"),
        ratio(_miles(), F.count("trip_distance_miles")).alias("avg_distance_miles"),
        ratio(F.sum("trip_duration_seconds"), F.count("trip_duration_seconds")).alias(
            "avg_duration_seconds"
        ),
    )


def build_zone_flows(
    spark: SparkSession, fact: DataFrame, path: str, *, month: Month | None = None
) -> None:
    """Incremental flows: the first build takes everything, even with a named month."""
    rows = fact
    built = fs.exists(spark, path)
    if built and month:
        rows = rows.filter(lake.within(F.col("source_month"), month.first, month.plus(1).first))
    elif built:
        newest = lake.newest(spark, path, "month_start")
        if newest is not None:
            rows = rows.filter(F.col("source_month") >= F.lit(newest))
    lake.swap_partitions(
        zone_flows(rows),
        path,
        ["month_start"],
        sort=["pu_location_id", "do_location_id"],
        full_refresh=not built,
    )


def airport_trips(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """A trip counts once: as a pickup where it starts at an airport, else as a dropoff.

    Both roles of the zone dimension are broadcast after a size check, so the fact is not shuffled
    for the joins.
    """
    side = zones.select("location_id", "airport_code", "is_airport")
    pickup = dimension(side.toDF("pu_location_id", "pickup_airport", "_pu_is_airport"))
    dropoff = dimension(side.toDF("do_location_id", "dropoff_airport", "_do_is_airport"))
    joined = (
        fact.join(pickup, "pu_location_id")
        .join(dropoff, "do_location_id")
        .filter(F.col("_pu_is_airport") | F.col("_do_is_airport"))
    )
    rows = F.count(F.lit(1))
    return joined.groupBy(
        month_start(F.col("pickup_date")).alias("month_start"),
        F.coalesce("pickup_airport", "dropoff_airport").alias("airport_code"),
        F.when(F.col("pickup_airport").isNotNull(), "pickup").otherwise("dropoff").alias("direction"),
    ).agg(
        _count(),
        ratio(F.sum("total_amount"), rows).alias("avg_total_amount"),
        ratio(_miles(), rows).alias("avg_distance_miles"),
        ratio(F.sum("trip_duration_seconds"), rows).alias("avg_duration_seconds"),
    )
