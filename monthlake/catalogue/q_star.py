"""Staging, dimensions and the fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthlake.catalogue import fixture as fx
from monthlake.catalogue.fixture import FACT_SQL, JUDGED_SQL, MARTS_SQL
from monthlake.catalogue.registry import number, query, text
from monthlake.functions.contract import FLAGS, TRIPS
from monthlake.functions.months import Month
from monthlake.plans import star
from monthlake.session import shared_folder
from monthlake.sources import lake

STAGED = [
    "trip_id", "vendor_id", "pickup_partition_ts", "pickup_datetime", "dropoff_datetime",
    "pickup_date", "trip_duration_seconds", "passenger_count", "trip_distance_miles",
    "ratecode_id", "store_and_fwd_flag", "pu_location_id", "do_location_id", "payment_type",
    *TRIPS.money, "source_month", *FLAGS,
]
TIMES = ("pickup_partition_ts", "pickup_datetime", "dropoff_datetime", "pickup_date", "source_month")


def sql_items(names) -> str:
    return ", ".join(
        text(n) if n in TIMES else number(n) if n in TRIPS.money else n for n in names
    )


@query("e04_stg_trips", f"{FACT_SQL} select {sql_items(STAGED)} from stg")
def stg_trips(spark, sf):
    return star.stage_trips(fx.curated_trips(spark, sf)).select(*STAGED)


@query(
    "e05_min_month",
    f"""{FACT_SQL} select {text('source_month')}, count(*) as trips,
      sum(trip_duration_seconds)::bigint as seconds
    from stg where pickup_datetime >= timestamp '1999-06-01' group by source_month""",
)
def min_month(spark, sf):
    staged = star.stage_trips(fx.curated_trips(spark, sf), Month.of("1999-06"))
    return staged.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("trip_duration_seconds").alias("seconds")
    )


@query(
    "f01_dim_date",
    f"""select cast(d as date)::varchar as date_day, year(d) as year, quarter(d) as quarter,
      month(d) as month, monthname(d) as month_name, day(d) as day_of_month,
      dayofweek(d) + 1 as day_of_week, dayname(d) as day_name,
      dayofweek(d) in (0, 6) as is_weekend, weekofyear(d) as iso_week,
      cast(date_trunc('month', d) as date)::varchar as month_start
    from (select unnest(generate_series(lo, hi, interval 1 day)) as d
      from (select min(o_orderdate) as lo, max(o_orderdate) as hi from orders))""",
)
def dim_date(spark, sf):
    """The calendar over the span of the orders table."""
    day = F.to_date("o_orderdate")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return star.dim_date(orders.agg(F.min(day).alias("date_start"), F.max(day).alias("date_end")))


def _with_trips(dim, fact, key, fact_key):
    """A dimension with the trips that use it; used codes are counted before the join."""
    used = fact.groupBy(F.col(fact_key).alias(key)).agg(F.count(F.lit(1)).alias("trips"))
    return dim.join(used, key, "left").withColumn("trips", F.coalesce("trips", F.lit(0)))


@query(
    "f02_dim_zone",
    f"""{MARTS_SQL} select location_id, borough, zone_name, service_zone, is_airport, airport_code,
      is_unknown_zone, coalesce(n, 0) as trips
    from dim_zone left join (select pu_location_id, count(*) as n from fct group by 1)
      on pu_location_id = location_id""",
)
def dim_zone(spark, sf):
    zone = star.dim_zone(fx.zones(spark, sf))
    return _with_trips(zone, fx.fact(spark, sf), "location_id", "pu_location_id")


def _values(rows) -> str:
    return ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v).lower() for v in r) + ")"
        for r in rows
    )


def _code_sql(rows, columns: str, key: str, extra: str = "") -> str:
    return f"""{FACT_SQL} select d.* replace ({key}::bigint as {key}){extra}, coalesce(n, 0) as trips
    from (values {_values(rows)}) d({columns})
    left join (select {key}, count(*) as n from fct group by 1) u using ({key})"""


@query(
    "f03_dim_vendor",
    _code_sql(star.VENDORS, "vendor_id, vendor_name, in_current_dictionary", "vendor_id"),
)
def dim_vendor(spark, sf):
    dim = star.dim_vendor(star.seed(spark, star.VENDORS, star.VENDOR_SCHEMA))
    return _with_trips(dim, fx.fact(spark, sf), "vendor_id", "vendor_id")


@query(
    "f04_dim_ratecode",
    _code_sql(
        star.RATE_CODES, "ratecode_id, rate_code_name", "ratecode_id",
        ", ratecode_id = 99 as is_unknown_rate",
    ),
)
def dim_ratecode(spark, sf):
    dim = star.dim_ratecode(star.seed(spark, star.RATE_CODES, star.RATE_SCHEMA))
    return _with_trips(dim, fx.fact(spark, sf), "ratecode_id", "ratecode_id")


@query(
    "f05_dim_payment",
    _code_sql(
        star.PAYMENT_TYPES, "payment_type, payment_type_name", "payment_type",
        ", payment_type = 1 as tips_are_recorded",
    ),
)
def dim_payment(spark, sf):
    dim = star.dim_payment_type(star.seed(spark, star.PAYMENT_TYPES, star.PAYMENT_SCHEMA))
    return _with_trips(dim, fx.fact(spark, sf), "payment_type", "payment_type")


@query("f06_fct_trips", f"{FACT_SQL} select {sql_items(star.FACT_COLUMNS)} from fct")
def fct_trips(spark, sf):
    return fx.fact(spark, sf)


@query(
    "c22_quality_flag",
    f"""{JUDGED_SQL} select {text('source_month')}, count(*) filter (where coalesce(
      is_zero_distance or is_zero_duration or is_long_duration or is_near_duplicate, false))
      as flagged, count(*) as trips
    from judged where reject_reason is null group by source_month""",
)
def quality_flag(spark, sf):
    return fx.fact(spark, sf).groupBy("source_month").agg(
        F.count_if("has_quality_flag").alias("flagged"), F.count(F.lit(1)).alias("trips")
    )


PER_MONTH_SQL = f"select {text('source_month')}, count(*) as trips, cast(sum(total_amount) as double) as total_amount"


def _per_month(table):
    return table.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("total_amount")
    )


def _curated_table(spark, sf) -> str:
    """Curated trips as a table, so the builds below read partitions as they do in service."""
    path = shared_folder(spark, "curated")
    lake.swap_partitions(fx.curated_trips(spark, sf), path, ["source_month"])
    return path


@query(
    "f07_incremental_overwrite",
    f"{FACT_SQL} {PER_MONTH_SQL} from fct group by source_month",
)
def incremental_overwrite(spark, sf):
    """Full build, then one month built again: the other months stay, nothing is doubled."""
    curated = lake.read_table(spark, _curated_table(spark, sf))
    path = shared_folder(spark, "fact")
    star.build_fact(spark, curated, path, grouped=True)
    star.build_fact(spark, curated, path, month=Month.of("1998-03"), grouped=True)
    return _per_month(lake.read_table(spark, path))


@query(
    "f08_month_window",
    f"""{FACT_SQL} {PER_MONTH_SQL} from fct
    where pickup_datetime >= timestamp '1998-03-01' and pickup_datetime < timestamp '1998-04-01'
    group by source_month""",
)
def month_window(spark, sf):
    """A named month narrows the first build as well."""
    curated = lake.read_table(spark, _curated_table(spark, sf))
    path = shared_folder(spark, "fact")
    star.build_fact(spark, curated, path, month=Month.of("1998-03"), grouped=True)
    return _per_month(lake.read_table(spark, path))


@query(
    "f09_newest_month",
    f"{FACT_SQL} {PER_MONTH_SQL} from fct group by source_month",
)
def newest_month(spark, sf):
    """Built up to a month's middle, then on from that month's start: the month is whole again."""
    curated = lake.read_table(spark, _curated_table(spark, sf))
    path = shared_folder(spark, "fact")
    early = F.col("pickup_datetime") < F.lit("2000-05-17 00:00:00").cast("timestamp_ntz")
    star.build_fact(spark, curated.filter(early), path, grouped=True)
    star.build_fact(spark, curated, path, grouped=True)
    return _per_month(lake.read_table(spark, path))


@query(
    "f12_high_water",
    f"{FACT_SQL} select cast(max(pickup_datetime) as varchar) as batch_high_water from fct",
)
def high_water(spark, sf):
    """The mark as the fact build stores it."""
    path = shared_folder(spark, "fact")
    star.build_fact(spark, lake.read_table(spark, _curated_table(spark, sf)), path, grouped=True)
    return star.stored_mark(spark, path)
