"""Report views: small re-shapes of the marts, with calendar and zone names joined on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.functions.columns import ratio
from monthlake.plans.joins import dimension
from monthlake.plans.star import AIRPORTS


def daily_overview(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    days = dimension(calendar.withColumnRenamed("date_day", "pickup_date"))
    return daily.join(days, "pickup_date").select(
        "pickup_date", "year", "quarter", "month", "month_name", "month_start", "day_name",
        "is_weekend", "trips", "flagged_trips", "trip_distance_miles", "fare_amount",
        "tip_amount", "total_amount", "card_tip_rate", "avg_passengers_per_recorded_trip",
        ratio(F.col("total_amount"), F.col("trips")).alias("avg_fare_per_trip"),
        ratio(F.col("trip_distance_miles"), F.col("trips")).alias("avg_miles_per_trip"),
    )


def _minutes(seconds: str = "avg_duration_seconds") -> Column:
    return (F.col(seconds) / 60).alias("avg_duration_minutes")


def hourly_profile(hourly: DataFrame, calendar: DataFrame) -> DataFrame:
    days = dimension(calendar.withColumnRenamed("date_day", "pickup_date"))
    return hourly.join(days, "pickup_date").select(
        "pickup_date", "pickup_hour", "year", "day_name", "day_of_week", "is_weekend", "trips",
        "total_amount", _minutes(), "avg_speed_mph",
    )


def zone_flows_named(flows: DataFrame, zones: DataFrame) -> DataFrame:
    side = zones.select("location_id", "borough", "zone_name", "is_airport", "is_unknown_zone")

    def role(name: str, key: str) -> DataFrame:
        return dimension(
            side.toDF(key, f"{name}_borough", f"{name}_zone", f"{name}_is_airport", f"_{name}_unknown")
        )

    joined = flows.join(role("pickup", "pu_location_id"), "pu_location_id").join(
        role("dropoff", "do_location_id"), "do_location_id"
    )
    return joined.select(
        "month_start", "pu_location_id", "do_location_id", "pickup_borough", "pickup_zone",
        "dropoff_borough", "dropoff_zone", "pickup_is_airport", "dropoff_is_airport",
        (F.col("_pickup_unknown") | F.col("_dropoff_unknown")).alias("has_unknown_zone"),
        "trips", "total_amount", "avg_distance_miles", _minutes(),
    )


def borough_flows(named: DataFrame) -> DataFrame:
    known = named.filter(~F.col("has_unknown_zone"))
    trips, total = F.sum("trips"), F.sum("total_amount")
    return known.groupBy("month_start", "pickup_borough", "dropoff_borough").agg(
        trips.alias("trips"),
        total.alias("total_amount"),
        ratio(total, trips).alias("avg_fare_per_trip"),
    )


def airport_monthly(airport: DataFrame) -> DataFrame:
    code = F.col("airport_code")
    name = F.coalesce(*[F.when(code == c, F.lit(n)) for c, n in AIRPORTS.values()])
    return airport.select(
        "month_start",
        F.year("month_start").alias("year"),
        code,
        name.alias("airport_name"),
        "direction",
        "trips",
        "avg_total_amount",
        "avg_distance_miles",
        _minutes(),
    )


def yearly_summary(daily: DataFrame) -> DataFrame:
    """Per year, from the daily mart: trips, revenue, revenue per trip, tips over fares."""
    trips, total = F.sum("trips"), F.sum("total_amount")
    return daily.groupBy(F.year("pickup_date").alias("year")).agg(
        trips.alias("trips"),
        total.alias("revenue"),
        ratio(total, trips).alias("revenue_per_trip"),
        ratio(F.sum("tip_amount"), F.sum("fare_amount")).alias("tip_share_of_fares"),
    )


def live_last_hour(events: DataFrame, as_of: Column | None = None, minutes: int = 60) -> DataFrame:
    """Accepted and rejected events per publish minute, over the last hour before `as_of`."""
    now = F.current_timestamp() if as_of is None else as_of
    kept = F.col("reject_reason").isNull()
    recent = events.filter(F.col("publish_time") >= now - F.expr(f"interval {minutes} minutes"))
    return recent.groupBy(F.date_trunc("minute", "publish_time").alias("minute")).agg(
        F.count_if(kept).alias("trips"),
        F.count_if(~kept).alias("rejected"),
        F.sum(F.when(kept, F.col("total_amount")).otherwise(0)).alias("revenue"),
    )


def stream_quality(
    deliveries: DataFrame, events: DataFrame, as_of: Column | None = None, hours: int = 24
) -> DataFrame:
    """Every delivery of the last day by outcome; what is left over are duplicate deliveries.

    Both inputs become counts first; the difference is one row and a scalar subquery.
    """
    now = F.current_timestamp() if as_of is None else as_of
    recent = F.col("publish_time") >= now - F.expr(f"interval {hours} hours")
    outcome = F.coalesce("reject_reason", F.lit("kept")).alias("outcome")
    counts = events.filter(recent).groupBy(outcome).agg(F.count(F.lit(1)).alias("events"))
    judged = events.filter(recent).agg(F.count(F.lit(1))).scalar()
    repeats = deliveries.filter(recent).agg(F.count(F.lit(1)).alias("_all")).select(
        F.lit("duplicate_delivery").alias("outcome"), (F.col("_all") - judged).alias("events")
    )
    return counts.unionByName(repeats)
