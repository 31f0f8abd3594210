"""Marts and reports, over trips and (twins with an n) over the native tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthlake.catalogue import fixture as fx
from monthlake.catalogue.fixture import MARTS_SQL
from monthlake.catalogue.registry import query, text
from monthlake.functions.columns import ratio
from monthlake.functions.months import Month, month_start
from monthlake.plans import marts, reports, star
from monthlake.plans.joins import dimension
from monthlake.session import shared_folder
from monthlake.sources import lake

DAILY = "trips, flagged_trips, trips_with_recorded_passengers, recorded_passengers, avg_passengers_per_recorded_trip, trip_distance_miles, fare_amount, tip_amount, total_amount, card_tip_rate"
FLOWS = "pu_location_id, do_location_id, trips, total_amount, avg_distance_miles, avg_duration_seconds"


@query("g01_daily", f"{MARTS_SQL} select {text('pickup_date')}, {DAILY} from daily")
def daily(spark, sf):
    return marts.daily_metrics(fx.fact(spark, sf))


@query(
    "g02_hourly",
    f"""{MARTS_SQL} select {text('pickup_date')}, pickup_hour, trips, total_amount,
      avg_duration_seconds, avg_speed_mph from hourly""",
)
def hourly(spark, sf):
    return marts.hourly_demand(fx.fact(spark, sf))


@query("g03_zone_flows", f"{MARTS_SQL} select {text('month_start')}, {FLOWS} from flows")
def zone_flows(spark, sf):
    return marts.zone_flows(fx.fact(spark, sf))


@query("g04_flows_incremental", f"{MARTS_SQL} select {text('month_start')}, {FLOWS} from flows")
def flows_incremental(spark, sf):
    """First build up to a month's middle, then incremental from that month, then one named month."""
    table, path = shared_folder(spark, "fact"), shared_folder(spark, "flows")
    lake.swap_partitions(fx.fact(spark, sf), table, ["source_month"])
    fact = lake.read_table(spark, table)
    early = F.col("pickup_date") < F.lit("2000-05-17").cast("date")
    marts.build_zone_flows(spark, fact.filter(early), path)
    marts.build_zone_flows(spark, fact, path)
    marts.build_zone_flows(spark, fact, path, month=Month.of("1997-02"))
    return lake.read_table(spark, path)


AIRPORT = "airport_code, direction, trips, avg_total_amount, avg_distance_miles"


@query(
    "g05_airport",
    f"{MARTS_SQL} select {text('month_start')}, {AIRPORT}, avg_duration_seconds from airport",
)
def airport(spark, sf):
    return marts.airport_trips(fx.fact(spark, sf), star.dim_zone(fx.zones(spark, sf)))


@query(
    "g01n_orders_daily",
    """select cast(cast(o_orderdate as date) as varchar) as order_date, count(*) as orders,
      count(*) filter (where o_orderstatus = 'F') as finished,
      cast(sum(cast(o_totalprice as decimal(15,2))) as double) as total,
      cast(sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(15,2)) else 0 end)
        as double) / nullif(cast(sum(cast(o_totalprice as decimal(15,2))) as double), 0)
        as finished_share
    from orders group by cast(o_orderdate as date)""",
)
def orders_daily(spark, sf):
    price = F.col("o_totalprice").cast("decimal(15,2)")
    finished = F.col("o_orderstatus") == "F"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return orders.groupBy(F.to_date("o_orderdate").alias("order_date")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(finished).alias("finished"),
        F.sum(price).alias("total"),
        ratio(F.sum(F.when(finished, price).otherwise(0)), F.sum(price)).alias("finished_share"),
    )


def _nation_lines(spark, sf):
    """Lines with buyer and seller nation. Lines meet orders, customers and suppliers on keys;
    the planner picks shuffled or broadcast joins by size, with skew handled at run time."""
    t = {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in ("lineitem", "orders", "customer", "supplier")}
    lines = t["lineitem"].select("l_orderkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    orders = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    buyers = t["customer"].select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("buyer"))
    sellers = t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("seller"))
    return lines.join(orders, "l_orderkey").join(buyers, "o_custkey").join(sellers, "l_suppkey")


NATION_LINES_SQL = """
  from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
  join supplier on s_suppkey = l_suppkey"""


@query(
    "g03n_nation_flows",
    f"""select cast(cast(date_trunc('month', l_shipdate) as date) as varchar) as month_start,
      b.n_name as buyer_nation, s.n_name as seller_nation, count(*) as lines,
      cast(sum(cast(l_extendedprice as decimal(15,2))) as double) as total
    {NATION_LINES_SQL} join nation b on b.n_nationkey = c_nationkey
    join nation s on s.n_nationkey = s_nationkey group by all""",
)
def nation_flows(spark, sf):
    """Aggregated on nation keys first; names join the small result."""
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    sums = (
        _nation_lines(spark, sf)
        .groupBy(month_start(F.to_date("l_shipdate")).alias("month_start"), "buyer", "seller")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("total"),
        )
    )

    def names(key):
        return dimension(nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(f"{key}_nation")))

    return sums.join(names("buyer"), "buyer").join(names("seller"), "seller").drop("buyer", "seller")


@query(
    "g05n_region_direction",
    f"""select coalesce(case when b.r_name in ('ASIA', 'EUROPE') then b.r_name end,
        case when s.r_name in ('ASIA', 'EUROPE') then s.r_name end) as region,
      case when b.r_name in ('ASIA', 'EUROPE') then 'buyer' else 'seller' end as direction,
      count(*) as lines
    {NATION_LINES_SQL} join nation bn on bn.n_nationkey = c_nationkey
    join region b on b.r_regionkey = bn.n_regionkey
    join nation sn on sn.n_nationkey = s_nationkey
    join region s on s.r_regionkey = sn.n_regionkey
    where b.r_name in ('ASIA', 'EUROPE') or s.r_name in ('ASIA', 'EUROPE') group by all""",
)
def region_direction(spark, sf):
    """One dimension in two roles, each line counted once, as for airports."""
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    region = spark.read.parquet(f"{sf}/region.parquet")
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    watched = F.when(F.col("r_name").isin("ASIA", "EUROPE"), F.col("r_name"))

    def role(key):
        return dimension(named.select(F.col("n_nationkey").alias(key), watched.alias(f"{key}_region")))

    joined = _nation_lines(spark, sf).join(role("buyer"), "buyer").join(role("seller"), "seller")
    buyer, seller = F.col("buyer_region"), F.col("seller_region")
    return (
        joined.filter(buyer.isNotNull() | seller.isNotNull())
        .groupBy(
            F.coalesce(buyer, seller).alias("region"),
            F.when(buyer.isNotNull(), "buyer").otherwise("seller").alias("direction"),
        )
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@query(
    "h01_daily_overview",
    f"""{MARTS_SQL} select {text('pickup_date')}, year, quarter, month, month_name,
      {text('month_start')}, day_name, is_weekend, trips, flagged_trips, trip_distance_miles,
      fare_amount, tip_amount, total_amount, card_tip_rate, avg_passengers_per_recorded_trip,
      total_amount / nullif(trips, 0)::double as avg_fare_per_trip,
      trip_distance_miles / nullif(trips, 0)::double as avg_miles_per_trip
    from daily join dim_date on date_day = pickup_date""",
)
def daily_overview(spark, sf):
    return reports.daily_overview(daily(spark, sf), fx.days(spark))


@query(
    "h02_hourly_profile",
    f"""{MARTS_SQL} select {text('pickup_date')}, pickup_hour, year, day_name, day_of_week,
      is_weekend, trips, total_amount, avg_duration_seconds / 60 as avg_duration_minutes,
      avg_speed_mph from hourly join dim_date on date_day = pickup_date""",
)
def hourly_profile(spark, sf):
    return reports.hourly_profile(hourly(spark, sf), fx.days(spark))


def _named(spark, sf):
    return reports.zone_flows_named(zone_flows(spark, sf), star.dim_zone(fx.zones(spark, sf)))


@query(
    "h03_zone_flows_named",
    f"""{MARTS_SQL} select * replace (cast(month_start as varchar) as month_start) from named""",
)
def zone_flows_named(spark, sf):
    return _named(spark, sf)


@query(
    "h04_borough_flows",
    f"""{MARTS_SQL} select {text('month_start')}, pickup_borough, dropoff_borough,
      sum(trips)::bigint as trips, t::double as total_amount, t::double / sum(trips)::double
        as avg_fare_per_trip
    from (select *, sum(cast(total_amount as decimal(38,2))) over (
      partition by month_start, pickup_borough, dropoff_borough) as t
      from named where not has_unknown_zone)
    group by month_start, pickup_borough, dropoff_borough, t""",
)
def borough_flows(spark, sf):
    return reports.borough_flows(_named(spark, sf))


@query(
    "h05_airport_monthly",
    f"""{MARTS_SQL} select {text('month_start')}, year(month_start) as year, airport_code,
      case airport_code when 'JFK' then 'JFK Airport' when 'LGA' then 'LaGuardia Airport'
        when 'EWR' then 'Newark Airport' end as airport_name, direction, trips, avg_total_amount,
      avg_distance_miles, avg_duration_seconds / 60 as avg_duration_minutes from airport""",
)
def airport_monthly(spark, sf):
    return reports.airport_monthly(airport(spark, sf))


@query(
    "h08_yearly",
    f"""{MARTS_SQL} select year(pickup_date) as year, sum(trips)::bigint as trips,
      sum(total_amount::decimal(38,2))::double as revenue,
      sum(total_amount::decimal(38,2))::double / sum(trips)::double as revenue_per_trip,
      sum(tip_amount::decimal(38,2))::double / sum(fare_amount::decimal(38,2))::double
        as tip_share_of_fares
    from daily group by 1""",
)
def yearly(spark, sf):
    return reports.yearly_summary(daily(spark, sf))
