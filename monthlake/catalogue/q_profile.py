"""Profiling over the trip-shaped lineitem and the native lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthlake.catalogue.fixture import TRIPS_SQL, typed_trips
from monthlake.catalogue.registry import query, text
from monthlake.operators import profile as pf

# typed_trips is before fills; the SQL twin reads the filled trips, so NULL fees are told by h.
RAW = TRIPS_SQL + """, unfilled as (
  select * replace (
    case when h % 11 = 0 then null else ratecode_id end as ratecode_id,
    case when h % 11 = 0 then null else congestion_surcharge end as congestion_surcharge,
    case when h % 19 = 0 then airport_fee end as airport_fee)
  from trips)"""
MINUTES = "(epoch_us(dropoff_datetime) - epoch_us(pickup_datetime))::double / 60000000"


def _n(condition: str, name: str) -> str:
    return f"count(*) filter (where {condition}) as {name}"


PROFILE_SQL = f"""{RAW} select {text('source_month')}, count(*) as trips, {', '.join([
    _n('passenger_count = 0', 'passenger_count_at_0'), _n('passenger_count > 6', 'passenger_count_over_6'),
    _n('minutes < 0', 'minutes_below_0'), _n('minutes = 0', 'minutes_at_0'),
    *[_n(f'minutes > {m}', f'minutes_over_{m}') for m in (180, 360, 1440)],
    _n('trip_distance < 0', 'trip_distance_below_0'), _n('trip_distance = 0', 'trip_distance_at_0'),
    *[_n(f'trip_distance > {m}', f'trip_distance_over_{m}') for m in (100, 500)],
    _n('fare_amount < 0', 'fare_amount_below_0'), _n('total_amount < 0', 'total_amount_below_0'),
    *[_n(f'total_amount > {m}', f'total_amount_over_{m}') for m in (1000, 10000)],
    *[_n(f'{c} is null', f'{c}_unknown') for c in ('passenger_count', 'airport_fee', 'congestion_surcharge')],
    _n('coalesce(passenger_count::varchar, ratecode_id::varchar, store_and_fwd_flag) is null', 'meter_unknown'),
    _n('pickup_datetime is null or dropoff_datetime is null', 'clock_unknown'),
    '0::bigint as passenger_count_broken', '0::bigint as amount_below_cents',
    _n('pickup_datetime < source_month', 'before_month'),
    _n('pickup_datetime >= source_month + interval 1 month', 'after_month'),
    _n('not coalesce(pu_location_id between 1 and 265 and do_location_id between 1 and 265, false)', 'zone_outside'),
    _n(' or '.join(f'coalesce({m} < 0, false)' for m in pf.MONEY), 'amount_below_0'),
])},
  cast(min(pickup_datetime) as varchar) as first_pickup, cast(max(pickup_datetime) as varchar) as last_pickup,
  max(minutes) as most_minutes, max(trip_distance) as most_miles, cast(max(total_amount) as double) as most_total,
  cast(max(greatest({', '.join(f'abs({m})' for m in pf.MONEY)})) as double) as most_amount
from (select *, {MINUTES} as minutes from unfilled) group by source_month"""


@query("k01_profile", PROFILE_SQL)
def profile(spark, sf):
    return pf.profile(typed_trips(spark, sf))


@query(
    "k01n_lineitem_profile",
    """select l_returnflag, count(*) as lines,
      count(*) filter (where l_discount > 0.05) as discounted,
      count(*) filter (where l_quantity > 40) as large,
      min(l_extendedprice) as price_min, max(l_extendedprice) as price_max,
      cast(max(l_shipdate) as varchar) as last_ship
    from lineitem group by 1""",
)
def lineitem_profile(spark, sf):
    return spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.count_if(F.col("l_quantity") > 40).alias("large"),
        F.min("l_extendedprice").alias("price_min"),
        F.max("l_extendedprice").alias("price_max"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query("k02_quantiles")
def quantiles(spark, sf):
    """Approximate by design, so no SQL twin; tests check the rank error."""
    q = pf.tail_quantiles(typed_trips(spark, sf))
    return q.select(
        *[
            F.col(c)[i].alias(f"{c.split('_')[0]}_{p}")
            for c in q.columns
            for i, p in enumerate(("p999", "p9999"))
        ]
    )


CODES_SQL = " union all ".join(
    f"""select '{c}' as "column", cast({c} as varchar) as value, count(*) as rows
    from unfilled group by {c}"""
    for c in pf.CODES
)


@query("k03_value_counts", f"{RAW} {CODES_SQL}")
def value_counts(spark, sf):
    return pf.value_counts(typed_trips(spark, sf))


@query(
    "k03n_lineitem_values",
    """select 'l_returnflag' as "column", l_returnflag as value, count(*) as rows
      from lineitem group by 2
    union all select 'l_linestatus', l_linestatus, count(*) from lineitem group by 2
    union all select 'l_linenumber', cast(l_linenumber as varchar), count(*)
      from lineitem group by 2""",
)
def lineitem_values(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    return pf.value_counts(lines, ("l_returnflag", "l_linestatus", "l_linenumber"))


def _excess_sql(source: str, columns) -> str:
    return f"""(select sum(n)::bigint as rows, sum(n - 1)::bigint as excess from
      (select count(*) as n from {source} group by {', '.join(columns)}))"""


@query(
    "k04_dup_excess",
    f"""{RAW} select 'full row' as by, * from {_excess_sql('trips', ['trip_id', 'source_month'])}
    union all select 'key', * from {_excess_sql('unfilled', pf.DUPLICATE_KEY)}""",
)
def dup_excess(spark, sf):
    trips = typed_trips(spark, sf).drop("processed_at")
    full = pf.duplicate_excess(trips, tuple(trips.columns)).select(F.lit("full row").alias("by"), "*")
    key = pf.duplicate_excess(trips, pf.DUPLICATE_KEY).select(F.lit("key").alias("by"), "*")
    return full.unionByName(key)


@query(
    "k04n_lineitem_excess",
    f"select * from {_excess_sql('lineitem', ['l_orderkey', 'l_linenumber'])}",
)
def lineitem_excess(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    return pf.duplicate_excess(lines, ("l_orderkey", "l_linenumber"))


NEG = "coalesce(fare_amount < 0 or total_amount < 0, false)"
POS = "(fare_amount >= 0 and total_amount >= 0)"
KEY_MATCH = " and ".join(
    f"n.{k} = p.{k}"
    for k in ("vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id")
)
NUMBERED = f"""{RAW}, numbered_trips as (select *, row_number() over () as rid from unfilled),
neg as (select * from numbered_trips where {NEG}),
pos as (select * from numbered_trips where {POS})"""


def _pairs(label: str) -> str:
    amounts = " and ".join(
        f"p.{a} is not distinct from -n.{a}" for a in pf.TWIN_KEYS[label]
    )
    return f"(select n.rid as n_rid, p.rid as p_rid from neg n join pos p on {KEY_MATCH} and {amounts})"


@query(
    "k05_twins",
    NUMBERED
    + " union all ".join(
        f" select '{label}' as twins_by, count(distinct n_rid) as matched_negatives from {_pairs(label)}"
        for label in pf.TWIN_KEYS
    ),
)
def twins(spark, sf):
    """Counts per group of twins; the SQL twin lists the pairs, this side never does."""
    return _twins(spark, sf).select("twins_by", "matched_negatives")


def _twins(spark, sf):
    return pf.twin_summaries(typed_trips(spark, sf))


@query(
    "k06_multiplicity",
    NUMBERED
    + " union all ".join(
        f""" select '{label}' as twins_by,
        (select count(*) from (select n_rid from {_pairs(label)} group by 1 having count(*) > 1))
          as negatives_with_many_twins,
        (select count(*) from (select p_rid from {_pairs(label)} group by 1 having count(*) > 1))
          as positives_claimed_twice"""
        for label in pf.TWIN_KEYS
    ),
)
def multiplicity(spark, sf):
    return _twins(spark, sf).drop("matched_negatives")


@query(
    "k07_inconsistent",
    f"""{RAW} select payment_type, count(*) filter (where total_amount = 0) as total_zero,
      count(*) filter (where total_amount > 0) as total_positive
    from (select payment_type, fare_amount, total_amount - 2 * fare_amount as total_amount
      from unfilled) where fare_amount < 0 and total_amount >= 0 group by 1""",
)
def inconsistent(spark, sf):
    """Refunds whose total kept its sign, made by taking the fare out of the total twice."""
    odd = typed_trips(spark, sf).withColumn(
        "total_amount", F.col("total_amount") - 2 * F.col("fare_amount")
    )
    return pf.inconsistent_negatives(odd)


@query(
    "k08_unmatched",
    f"""{NUMBERED} select payment_type, count(*) as unmatched from neg
    where rid not in (select n_rid from {_pairs('fare')}) group by 1""",
)
def unmatched(spark, sf):
    return pf.unmatched_negatives(typed_trips(spark, sf))


SPEED = f"""{RAW}, plausible as (
  select *, case when secs > 0 then trip_distance / (secs / 3600.0::double) end as mph
  from (select *, date_diff('second', pickup_datetime, dropoff_datetime) as secs from unfilled)
  where secs between 0 and 86400 and trip_distance between 0 and 500)"""


@query(
    "k09_speed",
    f"""{SPEED} select count(*) as trips, {', '.join([
        _n('secs = 0 and trip_distance > 0', 'jumps'), _n('secs = 0 and trip_distance >= 1', 'jumps_far'),
        _n('secs = 0 and trip_distance = 0', 'stands'), _n('trip_distance = 0', 'no_distance'),
        _n('secs > 10800', 'long'), _n('mph > 100 and trip_distance >= 1', 'fast_far'),
        *[_n(f'mph > {m}', f'mph_over_{m}') for m in (60, 80, 100, 200)],
    ])} from plausible""",
)
def speed(spark, sf):
    return pf.speed_counts(typed_trips(spark, sf))


@query("k09q_speed_quantiles")
def speed_quantiles(spark, sf):
    """Approximate by design, so no SQL twin; tests check the rank error."""
    q = pf.speed_quantiles(typed_trips(spark, sf))
    return q.select(*[F.col("mph_p50_p99_p999")[i].alias(f"mph_{p}") for i, p in enumerate(("p50", "p99", "p999"))])


@query(
    "k10_fast_medians",
    f"""{SPEED} select quantile_disc(trip_distance, 0.5) as median_miles,
      quantile_disc(secs, 0.5) as median_secs,
      cast(quantile_disc(fare_amount, 0.5) as double) as median_fare
    from plausible where mph > 100""",
)
def fast_medians(spark, sf):
    """A sketch: exact up to some ten thousand fast trips, as here; a bounded rank error beyond."""
    return pf.fast_medians(typed_trips(spark, sf))
