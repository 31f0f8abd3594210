"""Trip-shaped rows derived from lineitem, and deliveries derived from those.

One scan of lineitem; every line gives one trip, and some give a further copy, refund or variant.
The DuckDB text beside it derives the same rows for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.functions.columns import row_fingerprint
from monthlake.functions.contract import TRIPS
from monthlake.operators.classify import classify
from monthlake.operators.rules import REQUIRED
from monthlake.plans.star import calendar, fact_trips, stage_trips
from monthlake.session import configure
from monthlake.streaming.ingest import DELIVERED
from monthlake.streaming.wire import CARRIED, wire_event

PROCESSED_AT = "2002-01-01 00:00:00"
BATCH_UNTIL = "2001-09-01"
AS_OF = "2001-12-01 03:00:00"

# Shared by both engines: (name, expression over lineitem), later ones may use earlier ones.
_NUMBERS = [
    [
        ("h", "l_orderkey * 31 + l_partkey * 17 + cast(l_linenumber as bigint) * 7"),
        ("q", "cast(l_quantity as bigint)"),
        ("cents", "cast(floor(l_extendedprice / 10) as bigint)"),
    ],
    [
        ("nometer", "h % 11 = 0"),
        ("wq", "(120 + h % 5400) * q * 100"),
        (
            "secs",
            "case when h % 97 = 0 then -60 when h % 89 = 0 then 0 when h % 83 = 0 then 14400 "
            "when h % 211 = 0 then 90000 else 120 + h % 5400 end",
        ),
        ("vendor", "case h % 6 when 0 then 1 when 1 then 2 when 2 then 4 when 3 then 5 when 4 then 6 else 7 end"),
        ("pay", "case when h % 11 = 0 then 0 else 1 + h % 4 end"),
    ],
    [
        (
            "miles",
            "case when h % 101 = 0 or (h % 89 = 0 and h % 2 = 0) then cast(0 as double) "
            "when h % 103 = 0 then cast(-1 as double) when h % 107 = 0 then cast(600 as double) "
            "when h % 109 = 0 then cast(250 as double) "
            "else cast({div} as double) / cast(100 as double) end",
        ),
        ("pax", "case when nometer then null else h % 7 end"),
        ("rate", "case when nometer then null when h % 13 = 0 then 99 else 1 + h % 6 end"),
        ("flag", "case when nometer then null when h % 2 = 0 then 'N' else 'Y' end"),
        ("pu", "case when h % 127 = 0 then 0 else 1 + l_partkey % 265 end"),
        ("dropzone", "1 + (l_suppkey * 7 + l_orderkey) % 265"),
        ("c_fare", "case when h % 1009 = 0 then 2000000 else cents end"),
        ("c_tip", "case when pay = 1 then {tip} else 0 end"),
        ("c_tolls", "case when h % 17 = 0 then 694 else 0 end"),
        ("c_cong", "case when nometer then null else 250 end"),
        ("c_air", "case when h % 19 = 0 then 175 else null end"),
    ],
    [
        (
            "c_total",
            "c_fare + 50 + 50 + c_tip + c_tolls + 30 + coalesce(c_cong, 0) + coalesce(c_air, 0)",
        ),
    ],
]
_BRANCHES = {1: "h % 40 = 0", 2: "h % 53 = 0", 3: "h % 61 = 0", 4: "h % 67 = 0"}
# Raw money column -> cents before the branch's change.
_MONEY = {
    "fare_amount": "c_fare + case when branch = 4 then 1 else 0 end",
    "extra": "50",
    "mta_tax": "50",
    "tip_amount": "c_tip + case when branch = 3 then 100 else 0 end",
    "tolls_amount": "c_tolls",
    "improvement_surcharge": "30",
    "total_amount": "c_total + case when branch = 3 then 100 else 0 end",
    "congestion_surcharge": "c_cong",
    "airport_fee": "c_air",
}
_SIGN = "case when branch in (1, 4) then -1 else 1 end"
_PLAIN = {
    "VendorID": "cast(vendor as bigint)",
    "passenger_count": "cast(pax as bigint)",
    "trip_distance": "miles",
    "RatecodeID": "cast(rate as bigint)",
    "store_and_fwd_flag": "flag",
    "PULocationID": "cast(pu as bigint)",
    "DOLocationID": "cast(dropzone as bigint)",
    "payment_type": "cast(case when branch in (1, 4) then 4 else pay end as bigint)",
}


def _spell(text: str, integer_division: str) -> str:
    return text.replace("{div}", f"((wq - wq % 3600) {integer_division} 3600)").replace(
        "{tip}", f"((cents - cents % 10) {integer_division} 10)"
    )


def lineitem_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with the source file's column names, plus _branch, _h and _source_month."""
    configure(spark)
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for step in _NUMBERS:
        df = df.selectExpr("*", *[f"{_spell(e, 'div')} as {n}" for n, e in step])
    branches = ", ".join(f"case when {cond} then {b} end" for b, cond in _BRANCHES.items())
    df = df.selectExpr(
        "*",
        "timestampadd(SECOND, h % 86400, l_shipdate) as pickup",
        "case when h % 131 = 0 then add_months(trunc(cast(l_shipdate as date), 'month'), 1) "
        "else trunc(cast(l_shipdate as date), 'month') end as source_month",
        f"explode(array(0, {branches})) as branch",
    ).filter("branch is not null")
    return df.selectExpr(
        "branch as _branch",
        "h as _h",
        "source_month as _source_month",
        "pickup as tpep_pickup_datetime",
        "timestampadd(SECOND, secs, pickup) as tpep_dropoff_datetime",
        *[f"{e} as {n}" for n, e in _PLAIN.items()],
        *[f"cast({_SIGN} * ({e}) as double) / 100 as {n}" for n, e in _MONEY.items()],
    )


def typed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lineitem_trips(spark, sf_dir)
    clock = F.lit(PROCESSED_AT).cast("timestamp").alias("processed_at")
    return TRIPS.typed(raw, F.col("_source_month").alias("source_month"), clock)


def judged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(typed_trips(spark, sf_dir))


def curated_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [n for n, _ in TRIPS.curated_schema()]
    return judged_trips(spark, sf_dir).filter(F.col("reject_reason").isNull()).select(*names)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_trips(stage_trips(curated_trips(spark, sf_dir)))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """265 zones named after nations and regions."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    ids = spark.range(1, 266).select(F.col("id").alias("location_id"))
    return (
        ids.join(nation, F.col("location_id") % 25 == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "location_id",
            F.col("n_name").alias("borough"),
            F.concat(F.lit("Zone "), F.col("location_id").cast("string")).alias("zone_name"),
            F.col("r_name").alias("service_zone"),
        )
    )


def days(spark: SparkSession) -> DataFrame:
    return calendar(spark, "1995-01-01", "2001-12-31")


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip as a delivery, before fills; branch 2 repeats the event of branch 0."""
    raw = lineitem_trips(spark, sf_dir)
    typed = TRIPS.typed(raw, F.col("_branch").alias("_branch"), F.col("_h").alias("_h"))
    late = F.expr("timestampadd(SECOND, _h % 10800 + 3 * _branch, timestamp '2001-12-01 00:00:00')")
    trips = typed.withColumns({"event_id": row_fingerprint(TRIPS.names), "publish_time": late})
    return trips.withColumns(
        {
            "event_ts": F.col("publish_time"),
            "message_id": F.concat_ws("-", "event_id", F.col("_branch").cast("string")),
            "subscription_name": F.lit("live-trips"),
            "attributes": F.to_json(F.struct(F.col("_branch").cast("string").alias("branch"))),
        }
    )


def envelopes(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """The deliveries on the wire.

    With faults, some texts lose a required field and some a union's branch name.
    """
    trips = _delivered(spark, sf_dir)
    data = wire_event(trips, event_id=F.col("event_id"), event_ts=F.col("event_ts"))
    if faults:
        no_fare = F.regexp_replace(data, '"fare_amount":"[^"]*",', "")
        bare = F.regexp_replace(data, r'"passenger_count":\{"long":(\d+)\}', '"passenger_count":$1')
        h = F.col("_h")
        data = (
            F.when(h % 71 == 0, no_fare)
            .when(h % 73 == 0, F.lit("not json"))
            .when((h % 79 == 0) & (h % 11 != 0), bare)
            .otherwise(data)
        )
    return trips.select("message_id", "publish_time", data.alias("data"), *CARRIED)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries as the ingest stores them (i08 and a18 take the way over the wire)."""
    return _delivered(spark, sf_dir).select(*DELIVERED)


# ---------------------------------------------------------------- the same rows for DuckDB


def _duck_raw() -> str:
    layers = "lineitem"
    for step in _NUMBERS:
        cols = ", ".join(f"{_spell(e, '//')} as {n}" for n, e in step)
        layers = f"(select *, {cols} from {layers})"
    extra = " ".join(
        f"union all select *, {b} as branch from numbered where {cond}"
        for b, cond in _BRANCHES.items()
    )
    plain = ", ".join(f"{e} as {n}" for n, e in _PLAIN.items())
    money = ", ".join(
        f"cast(cast({_SIGN} * ({e}) as double) / 100 as decimal(15,2)) as {n}"
        for n, e in _MONEY.items()
    )
    return f"""
numbered as (select * from {layers}),
branched as (select *, 0 as branch from numbered {extra}),
stamped as (
  select *, l_shipdate + to_seconds(h % 86400) as pickup,
    cast(date_trunc('month', l_shipdate) + case when h % 131 = 0 then interval 1 month
         else interval 0 month end as date) as source_month
  from branched),
raw_trips as (
  select branch, h, source_month, pickup as tpep_pickup_datetime,
    pickup + to_seconds(secs) as tpep_dropoff_datetime, {plain}, {money}
  from stamped)"""


def _duck_canonical() -> str:
    parts, plain = [], []
    for c in TRIPS.columns:
        value = "null" if c.name == "cbd_congestion_fee" else c.source
        kind = {"timestamp_ntz": "timestamp", "string": "varchar"}.get(c.type, c.type)
        value = f"cast({value} as {kind})"
        parts.append(f"coalesce(cast({value} as varchar), chr(0))")
        filled = f"coalesce({value}, {TRIPS.fills[c.name]})" if c.name in TRIPS.fills else value
        plain.append(f"{filled} as {c.name}")
    return f"""
trips as (
  select md5(concat_ws(chr(31), {', '.join(parts)})) as trip_id, {', '.join(plain)},
    source_month, branch, h
  from raw_trips)"""


def _duck_judged() -> str:
    money = TRIPS.money
    negative = " or ".join(f"coalesce({m} < 0, false)" for m in money)
    signed = ", ".join(f"case when neg then -{m} else {m} end as o_{m}" for m in money)
    identity = "source_month, vendor_id, pickup_datetime, dropoff_datetime, pu_location_id, do_location_id"
    sig = f"{identity}, {', '.join('o_' + m for m in money)}"
    secs = "date_diff('second', pickup_datetime, dropoff_datetime)"
    rules = {
        "missing_required_field": " or ".join(f"{c} is null" for c in REQUIRED),
        "invalid_location_id": "pu_location_id not between 1 and 265 or do_location_id not between 1 and 265",
        "pickup_outside_source_month": "pickup_datetime < source_month or pickup_datetime >= source_month + interval 1 month",
        "dropoff_before_pickup": "dropoff_datetime < pickup_datetime",
        "duration_over_24h": "dropoff_datetime - pickup_datetime > interval 24 hours",
        "negative_distance": "trip_distance < 0",
        "distance_over_500_miles": "trip_distance > 500",
        "implied_speed_over_100_mph": f"({secs} > 0 and trip_distance / ({secs} / 3600.0::double) > 100) or ({secs} = 0 and trip_distance > 0)",
        "amount_out_of_range": " or ".join(f"abs({m}) > 10000" for m in money),
        "reversal_negative_row": "neg and paired",
        "reversed_by_negative_row": "not neg and paired",
        "negative_amount_unmatched": "neg and not paired",
    }
    cases = ", ".join(f"case when {c} then '{code}' end" for code, c in rules.items())
    return f"""
signed as (select *, {signed} from (select *, ({negative}) as neg from trips)),
sided as (
  select *, row_number() over (partition by {sig}, neg order by trip_id) as rn,
    count(*) filter (where neg) over (partition by {sig}) as n_neg,
    count(*) filter (where not neg) over (partition by {sig}) as n_pos
  from signed),
failed as (
  select *, [x for x in [{cases}] if x is not null] as codes
  from (select *, rn <= least(n_neg, n_pos) as paired from sided)),
copied as (
  select *, row_number() over (partition by source_month, trip_id, len(codes) = 0 order by trip_id)
    as copy_no from failed),
reasoned as (
  select *, case when len(codes) = 0 and copy_no > 1 then ['duplicate_row'] else codes end
    as reject_reasons from copied),
judged as (
  select *, reject_reasons[1] as reject_reason,
    trip_distance = 0 as is_zero_distance,
    dropoff_datetime = pickup_datetime as is_zero_duration,
    dropoff_datetime - pickup_datetime > interval 3 hours as is_long_duration,
    len(reject_reasons) = 0 and count(*) over (
      partition by {identity}, fare_amount, len(reject_reasons) = 0) > 1 as is_near_duplicate
  from reasoned)"""


def _duck_fact() -> str:
    names = ", ".join(TRIPS.names[5:])
    return f"""
stg as (
  select trip_id, vendor_id, pickup_datetime as pickup_partition_ts, pickup_datetime,
    dropoff_datetime, cast(pickup_datetime as date) as pickup_date,
    date_diff('second', pickup_datetime, dropoff_datetime) as trip_duration_seconds,
    passenger_count, trip_distance as trip_distance_miles, {names}, source_month,
    is_zero_distance, is_zero_duration, is_long_duration, is_near_duplicate
  from judged where reject_reason is null),
fct as (
  select *, hour(pickup_datetime) as pickup_hour,
    coalesce(is_zero_distance or is_zero_duration or is_long_duration or is_near_duplicate, false)
      as has_quality_flag
  from stg)"""


# The digits a distance is written with, summed exactly; twelve decimals round none of them.
_MILES = "sum(cast(cast(trip_distance_miles as varchar) as decimal(38,12)))::double"
_SPEED = f"{_MILES} / nullif(sum(trip_duration_seconds)::double / 3600, 0)"


def _duck_marts() -> str:
    return f"""
zones as (
  select z.location_id, n_name as borough, 'Zone ' || z.location_id as zone_name,
    r_name as service_zone
  from (select unnest(range(1, 266)) as location_id) z
  join nation on n_nationkey = z.location_id % 25 join region on r_regionkey = n_regionkey),
dim_zone as (
  select *, location_id in (1, 132, 138) as is_airport,
    case location_id when 1 then 'EWR' when 132 then 'JFK' when 138 then 'LGA' end as airport_code,
    location_id in (264, 265) as is_unknown_zone
  from zones),
dim_date as (
  select cast(d as date) as date_day, year(d) as year, quarter(d) as quarter, month(d) as month,
    monthname(d) as month_name, day(d) as day_of_month, dayofweek(d) + 1 as day_of_week,
    dayname(d) as day_name, dayofweek(d) in (0, 6) as is_weekend, weekofyear(d) as iso_week,
    cast(date_trunc('month', d) as date) as month_start
  from (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-31',
    interval 1 day)) as d)),
daily as (
  select pickup_date, count(*) as trips, count(*) filter (where has_quality_flag) as flagged_trips,
    count(passenger_count) as trips_with_recorded_passengers,
    sum(passenger_count)::bigint as recorded_passengers,
    sum(passenger_count)::double / nullif(count(passenger_count), 0)
      as avg_passengers_per_recorded_trip,
    {_MILES} as trip_distance_miles, sum(fare_amount)::double as fare_amount,
    sum(tip_amount)::double as tip_amount, sum(total_amount)::double as total_amount,
    sum(case when payment_type = 1 then tip_amount else 0 end)::double
      / nullif(sum(case when payment_type = 1 then fare_amount else 0 end)::double, 0)
      as card_tip_rate
  from fct group by pickup_date),
hourly as (
  select pickup_date, pickup_hour, count(*) as trips, sum(total_amount)::double as total_amount,
    sum(trip_duration_seconds)::double / count(*) as avg_duration_seconds,
    {_SPEED} as avg_speed_mph
  from fct group by all),
flows as (
  select cast(date_trunc('month', pickup_date) as date) as month_start, pu_location_id,
    do_location_id, count(*) as trips, sum(total_amount)::double as total_amount,
    {_MILES} / count(*) as avg_distance_miles,
    sum(trip_duration_seconds)::double / count(*) as avg_duration_seconds
  from fct group by all),
airport as (
  select cast(date_trunc('month', pickup_date) as date) as month_start,
    coalesce(p.airport_code, d.airport_code) as airport_code,
    case when p.airport_code is not null then 'pickup' else 'dropoff' end as direction,
    count(*) as trips, sum(total_amount)::double / count(*) as avg_total_amount,
    {_MILES} / count(*) as avg_distance_miles,
    sum(trip_duration_seconds)::double / count(*) as avg_duration_seconds
  from fct join dim_zone p on p.location_id = pu_location_id
    join dim_zone d on d.location_id = do_location_id
  where p.is_airport or d.is_airport group by all),
named as (
  select month_start, pu_location_id, do_location_id, p.borough as pickup_borough,
    p.zone_name as pickup_zone, d.borough as dropoff_borough, d.zone_name as dropoff_zone,
    p.is_airport as pickup_is_airport, d.is_airport as dropoff_is_airport,
    p.is_unknown_zone or d.is_unknown_zone as has_unknown_zone, trips, total_amount,
    avg_distance_miles, avg_duration_seconds / 60 as avg_duration_minutes
  from flows join dim_zone p on p.location_id = pu_location_id
    join dim_zone d on d.location_id = do_location_id)"""


def _duck_stream() -> str:
    money = ", ".join(
        f"cast({m} as decimal(15,2)) as {m}" for m in TRIPS.money
    )
    rules = {
        "missing_required_field": "vendor_id is null or pickup_datetime is null or dropoff_datetime is null or pu_location_id is null or do_location_id is null or payment_type is null or trip_distance_miles is null or fare_amount is null or total_amount is null",
        "invalid_location_id": "pu_location_id not between 1 and 265 or do_location_id not between 1 and 265",
        "dropoff_before_pickup": "dropoff_datetime < pickup_datetime",
        "duration_over_24h": "trip_duration_seconds > 86400",
        "negative_distance": "trip_distance_miles < 0",
        "distance_over_500_miles": "trip_distance_miles > 500",
        "implied_speed_over_100_mph": "(trip_duration_seconds > 0 and trip_distance_miles / (trip_duration_seconds / 3600.0::double) > 100) or (trip_duration_seconds = 0 and trip_distance_miles > 0)",
        "amount_out_of_range": " or ".join(f"abs({m}) > 10000" for m in TRIPS.money),
        "negative_amount_unmatched": " or ".join(f"{m} < 0" for m in TRIPS.money),
    }
    case = " ".join(f"when {c} then '{code}'" for code, c in rules.items())
    plain = "vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance as trip_distance_miles, ratecode_id, store_and_fwd_flag, pu_location_id, do_location_id, payment_type"
    return f"""
stored as (
  select trip_id as event_id, trip_id || '-' || branch as message_id,
    timestamp '2001-12-01 00:00:00' + to_seconds(h % 10800 + 3 * branch) as publish_time,
    {plain}, {money}
  from trips),
firsts as (
  select * from stored
  qualify row_number() over (partition by event_id order by publish_time, message_id) = 1),
typed_events as (
  select *, cast(pickup_datetime as date) as pickup_date, hour(pickup_datetime) as pickup_hour,
    date_diff('second', pickup_datetime, dropoff_datetime) as trip_duration_seconds
  from firsts),
checked as (select *, case {case} end as reject_reason from typed_events),
events_judged as (
  select *, trip_distance_miles = 0 as is_zero_distance,
    trip_duration_seconds = 0 as is_zero_duration,
    trip_duration_seconds > 10800 as is_long_duration,
    reject_reason is null and count(*) over (
      partition by vendor_id, pickup_datetime, dropoff_datetime, pu_location_id, do_location_id,
        fare_amount, reject_reason is null) > 1 as is_near_duplicate
  from checked),
live as (
  select event_id as trip_id, pickup_datetime as pickup_partition_ts, * exclude (event_id),
    coalesce(is_zero_distance or is_zero_duration or is_long_duration or is_near_duplicate, false)
      as has_quality_flag
  from events_judged where reject_reason is null)"""


RAW_SQL = "with " + _duck_raw()
TRIPS_SQL = RAW_SQL + "," + _duck_canonical()
JUDGED_SQL = TRIPS_SQL + "," + _duck_judged()
FACT_SQL = JUDGED_SQL + "," + _duck_fact()
MARTS_SQL = FACT_SQL + "," + _duck_marts()
STREAM_SQL = FACT_SQL + "," + _duck_stream()
EVERY_SQL = MARTS_SQL + "," + _duck_stream()
