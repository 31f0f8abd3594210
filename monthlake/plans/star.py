"""Staging, dimensions and the trip fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.functions.columns import whole_seconds
from monthlake.functions.contract import FLAGS
from monthlake.functions.months import Month, month_start
from monthlake.operators.rules import has_any_flag
from monthlake.sources import fs, lake

# Lookup rows that reports must show as they are.
VENDORS = [
    (1, "Creative Mobile Technologies LLC", True),
    (2, "Curb Mobility LLC", True),
    (4, "Not in the TLC dictionary", False),
    (5, "Not in the TLC dictionary", False),
    (6, "Myle Technologies Inc", True),
    (7, "Helix", True),
]
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Null/unknown"),
]
PAYMENT_TYPES = [
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
AIRPORTS = {1: ("EWR", "Newark Airport"), 132: ("JFK", "JFK Airport"), 138: ("LGA", "LaGuardia Airport")}
UNKNOWN_ZONES = (264, 265)
CARD = 1

VENDOR_SCHEMA = "vendor_id bigint, vendor_name string, in_current_dictionary boolean"
RATE_SCHEMA = "ratecode_id bigint, rate_code_name string"
PAYMENT_SCHEMA = "payment_type bigint, payment_type_name string"
ZONE_SCHEMA = "location_id bigint, borough string, zone_name string, service_zone string"

# Output names of the fact, in order.
FACT_COLUMNS = (
    "trip_id", "pickup_partition_ts", "pickup_datetime", "dropoff_datetime", "pickup_date",
    "pickup_hour", "trip_duration_seconds", "vendor_id", "ratecode_id", "payment_type",
    "pu_location_id", "do_location_id", "passenger_count", "trip_distance_miles", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount",
    "store_and_fwd_flag", "source_month", *FLAGS, "has_quality_flag",
)


def stage_trips(curated: DataFrame, min_month: Month | None = None) -> DataFrame:
    """Typed, renamed view of curated trips; min_month prunes partitions of the source."""
    rows = curated
    if min_month:
        # source_month equals the pickup month on curated rows, and it is the directory.
        rows = rows.filter(F.col("source_month") >= F.lit(min_month.first))
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    renamed = {
        "trip_distance": "trip_distance_miles",
    }
    carried = [F.col(c).alias(renamed.get(c, c)) for c in curated.columns if c != "pickup_datetime"]
    return rows.select(
        *carried,
        pickup.cast("timestamp").alias("pickup_partition_ts"),
        pickup,
        F.to_date(pickup).alias("pickup_date"),
        whole_seconds(pickup, dropoff).alias("trip_duration_seconds"),
    )


def fact_trips(staged: DataFrame) -> DataFrame:
    return staged.withColumns(
        {
            "pickup_hour": F.hour("pickup_datetime").cast("long"),
            "has_quality_flag": has_any_flag(FLAGS),
        }
    ).select(*FACT_COLUMNS)


# ---------------------------------------------------------------- dimensions


def seed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def dim_vendor(vendors: DataFrame) -> DataFrame:
    return vendors.select("vendor_id", "vendor_name", "in_current_dictionary")


def dim_ratecode(rate_codes: DataFrame) -> DataFrame:
    return rate_codes.select(
        "ratecode_id", "rate_code_name", (F.col("ratecode_id") == 99).alias("is_unknown_rate")
    )


def dim_payment_type(payment_types: DataFrame) -> DataFrame:
    return payment_types.select(
        "payment_type",
        "payment_type_name",
        (F.col("payment_type") == CARD).alias("tips_are_recorded"),
    )


def dim_zone(zones: DataFrame) -> DataFrame:
    zone = F.col("location_id")
    code = F.coalesce(*[F.when(zone == i, F.lit(c)) for i, (c, _) in AIRPORTS.items()])
    return zones.select(
        "location_id",
        "borough",
        "zone_name",
        "service_zone",
        zone.isin(*AIRPORTS).alias("is_airport"),
        code.alias("airport_code"),
        zone.isin(*UNKNOWN_ZONES).alias("is_unknown_zone"),
    )


def dim_date(bounds: DataFrame, first: str = "date_start", last: str = "date_end") -> DataFrame:
    """One row per day between the two dates of the one-row frame `bounds`."""
    day = F.col("date_day")
    weekday = F.dayofweek(day)  # 1 = Sunday
    return bounds.select(F.explode(F.sequence(first, last)).alias("date_day")).select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(1, 7).alias("is_weekend"),
        F.weekofyear(day).alias("iso_week"),
        month_start(day).alias("month_start"),
    )


def calendar(spark: SparkSession, first: str = "2019-01-01", last: str = "2025-12-31") -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(date.fromisoformat(first)).alias("date_start"),
        F.lit(date.fromisoformat(last)).alias("date_end"),
    )
    return dim_date(bounds)


def high_water_mark(fact: DataFrame) -> DataFrame:
    """One row: the latest pickup batch data covers (NULL for an empty fact)."""
    return fact.agg(F.max("pickup_datetime").alias("batch_high_water"))


def mark_path(fact_path: str) -> str:
    return f"{fact_path.rstrip('/')}_high_water_mark"


def stored_mark(spark: SparkSession, fact_path: str) -> DataFrame:
    """The mark written with the last fact build; serving reads this one row and not the fact."""
    return spark.read.parquet(mark_path(fact_path))


def _store_mark(spark: SparkSession, path: str) -> None:
    """From the newest partition alone: a fact's source month is its pickup month."""
    rows = lake.read_table(spark, path)
    newest = lake.newest(spark, path, "source_month")
    if newest is not None:
        rows = rows.filter(F.col("source_month") == F.lit(newest))
    high_water_mark(rows).coalesce(1).write.mode("overwrite").parquet(mark_path(path))


# ---------------------------------------------------------------- incremental build


def build_fact(
    spark: SparkSession,
    curated: DataFrame,
    path: str,
    *,
    month: Month | None = None,
    min_month: Month | None = None,
    full_refresh: bool = False,
    grouped: bool = False,
) -> None:
    """Write the fact: one named month, or from the newest month present on, or everything.

    A named month narrows the first build too. Only partitions present in the new rows are
    replaced; a changed schema fails an incremental build. `grouped`: curated is read from a table partitioned by
    source month, so its rows need no exchange (see `lake.swap_partitions`).
    """
    rows = curated
    key = F.col("source_month")
    built = fs.exists(spark, path) and not full_refresh
    if month:
        rows = rows.filter(lake.within(key, month.first, month.plus(1).first))
    elif built:
        newest = lake.newest(spark, path, "source_month")
        if newest is not None:
            rows = rows.filter(key >= F.lit(newest))
    fact = fact_trips(stage_trips(rows, min_month))
    if built:
        lake.guard_schema(spark, fact, path)
    lake.swap_partitions(
        fact,
        path,
        ["source_month"],
        sort=["pu_location_id", "do_location_id"],
        full_refresh=not built,
        grouped=grouped,
    )
    if fs.child_dirs(spark, path):
        _store_mark(spark, path)
    else:  # no partition: an empty fact, whose mark is NULL
        high_water_mark(fact.limit(0)).write.mode("overwrite").parquet(mark_path(path))
