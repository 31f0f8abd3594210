"""Contract, rules and data-quality counts over the trip-shaped lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthlake.catalogue.fixture import (
    JUDGED_SQL,
    RAW_SQL,
    TRIPS_SQL,
    judged_trips,
    lineitem_trips,
    typed_trips,
)
from monthlake.catalogue.registry import number, query, text
from monthlake.functions.columns import row_fingerprint
from monthlake.functions.contract import FLAGS, TRIPS
from monthlake.operators import dq
from monthlake.operators.classify import classify
from monthlake.operators.rules import RULE_CODES

PLAIN = "trip_id, vendor_id, passenger_count, trip_distance, ratecode_id, store_and_fwd_flag, pu_location_id, do_location_id, payment_type"
TIMES = text("pickup_datetime", "dropoff_datetime", "source_month")
CORE_SQL = f"{PLAIN}, {TIMES}, {number(*TRIPS.money)}"
CORE = [n for n, _ in TRIPS.core_schema() if n != "processed_at"]


@query("b01_canonicalize", f"{TRIPS_SQL} select {CORE_SQL} from trips")
def canonicalize(spark, sf):
    return TRIPS.identified(typed_trips(spark, sf)).select(*CORE)


@query(
    "b04_exact_money",
    f"""{RAW_SQL} select {text('source_month')}, count(*) as n, {', '.join(
        f'cast(sum({m}) as double) as {m}' for m in ('fare_amount', 'tip_amount', 'total_amount'))}
    from raw_trips group by source_month""",
)
def exact_money(spark, sf):
    money = ("fare_amount", "tip_amount", "total_amount")
    return typed_trips(spark, sf).groupBy("source_month").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in money]
    )


@query("b05_fingerprint", f"{TRIPS_SQL} select trip_id, count(*) as copies from trips group by 1")
def fingerprint(spark, sf):
    ids = TRIPS.identified(typed_trips(spark, sf)).select("trip_id")
    return ids.groupBy("trip_id").agg(F.count(F.lit(1)).alias("copies"))


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    "b05n_orders_fingerprint",
    f"""select o_orderkey, md5(concat_ws(chr(31), {', '.join(
        f'coalesce(cast({c} as varchar), chr(0))' for c in ORDER_COLUMNS)})) as row_id
    from orders""",
)
def orders_fingerprint(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return orders.select("o_orderkey", row_fingerprint(ORDER_COLUMNS).alias("row_id"))


@query(
    "b06_ratecode_fill",
    f"{TRIPS_SQL} select ratecode_id, count(*) as n from trips group by 1",
)
def ratecode_fill(spark, sf):
    filled = TRIPS.identified(typed_trips(spark, sf))
    return filled.groupBy("ratecode_id").agg(F.count(F.lit(1)).alias("n"))


FEES = ("congestion_surcharge", "airport_fee", "cbd_congestion_fee")


@query(
    "b07_fee_fill",
    f"""{TRIPS_SQL} select {number(*FEES)}, count(*) as n from trips
    group by {', '.join(FEES)}""",
)
def fee_fill(spark, sf):
    filled = TRIPS.identified(typed_trips(spark, sf))
    return filled.groupBy(*FEES).agg(F.count(F.lit(1)).alias("n"))


@query(
    "b09_eras_union",
    f"""{TRIPS_SQL} select {text('source_month')}, count(*) as n,
      count(distinct trip_id) as ids, cast(sum(airport_fee) as double) as airport_fee,
      cast(sum(passenger_count) as bigint) as passengers
    from trips group by source_month""",
)
def eras_union(spark, sf):
    """Two physical eras of the same rows: other types, other case, an absent optional column."""
    raw = lineitem_trips(spark, sf)
    month = F.col("_source_month").alias("source_month")
    old_rows = raw.filter(F.col("_source_month") < F.lit("1998-01-01").cast("date"))
    new_rows = raw.filter(F.col("_source_month") >= F.lit("1998-01-01").cast("date"))
    old = old_rows.withColumns(
        {c: F.col(c).cast("double") for c in ("passenger_count", "RatecodeID")}
    )
    new = new_rows.withColumns(
        {c: F.col(c).cast("int") for c in ("VendorID", "PULocationID", "DOLocationID")}
    ).withColumnRenamed("airport_fee", "Airport_fee")
    new = new.withColumn("cbd_congestion_fee", F.lit(None).cast("double"))
    both = TRIPS.typed(old, month).unionByName(TRIPS.typed(new, month))
    return TRIPS.identified(both).groupBy("source_month").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("trip_id").alias("ids"),
        F.sum("airport_fee").alias("airport_fee"),
        F.sum("passenger_count").alias("passengers"),
    )


# Rules C2 to C13: every row that fails the rule, counted per month with all reasons it failed.
RULE_QUERIES = {
    "c02_invalid_location": "invalid_location_id",
    "c03_outside_month": "pickup_outside_source_month",
    "c04_dropoff_before_pickup": "dropoff_before_pickup",
    "c05_duration_over_24h": "duration_over_24h",
    "c06_negative_distance": "negative_distance",
    "c07_distance_over_500": "distance_over_500_miles",
    "c08_implied_speed": "implied_speed_over_100_mph",
    "c09_amount_out_of_range": "amount_out_of_range",
    "c10_reversal_negative": "reversal_negative_row",
    "c11_reversed_by_negative": "reversed_by_negative_row",
    "c12_negative_unmatched": "negative_amount_unmatched",
    "c13_duplicate_row": "duplicate_row",
}


def _rule_query(name: str, code: str) -> None:
    @query(
        name,
        f"""{JUDGED_SQL} select trip_id, {text('source_month')},
          array_to_string(reject_reasons, ',') as reject_reasons
        from judged where list_contains(reject_reasons, '{code}')""",
    )
    def rule(spark, sf):
        hit = judged_trips(spark, sf).filter(F.array_contains("reject_reasons", code))
        return hit.select("trip_id", "source_month", "reject_reasons")


for _name, _code in RULE_QUERIES.items():
    _rule_query(_name, _code)


@query(
    "c01_missing_required",
    f"""{JUDGED_SQL.replace('cast(pu as bigint) as PULocationID',
        'nullif(cast(pu as bigint), 0) as PULocationID')}
    select trip_id, {text('source_month')}, array_to_string(reject_reasons, ',') as reject_reasons
    from judged where list_contains(reject_reasons, 'missing_required_field')""",
)
def missing_required(spark, sf):
    """The fixture has no NULL in a required column, so its zone 0 is taken as not recorded."""
    trips = typed_trips(spark, sf).withColumn("pu_location_id", F.nullif("pu_location_id", F.lit(0)))
    hit = classify(trips).filter(F.array_contains("reject_reasons", "missing_required_field"))
    return hit.select("trip_id", "source_month", "reject_reasons")


@query(
    "c14_reversal_pairs",
    f"""{JUDGED_SQL} select {text('source_month')}, count(*) filter (where neg) as negatives,
      count(*) filter (where neg and paired) as paired_negatives,
      count(*) filter (where not neg and paired) as paired_originals
    from failed group by source_month""",
)
def reversal_pairs(spark, sf):
    judged = judged_trips(spark, sf)
    has = {c: F.array_contains("reject_reasons", c) for c in RULE_CODES[9:12]}
    negative = has["reversal_negative_row"] | has["negative_amount_unmatched"]
    return judged.groupBy("source_month").agg(
        F.count_if(negative).alias("negatives"),
        F.count_if(has["reversal_negative_row"]).alias("paired_negatives"),
        F.count_if(has["reversed_by_negative_row"]).alias("paired_originals"),
    )


@query(
    "c15_all_reasons",
    f"""{JUDGED_SQL} select array_to_string(reject_reasons, ',') as reject_reasons, count(*) as n
    from judged group by 1""",
)
def all_reasons(spark, sf):
    return judged_trips(spark, sf).groupBy("reject_reasons").agg(F.count(F.lit(1)).alias("n"))


@query(
    "c16_primary_reason",
    f"""{JUDGED_SQL} select {text('source_month')}, coalesce(reject_reason, 'kept') as reason,
      count(*) as n from judged group by source_month, reject_reason""",
)
def primary_reason(spark, sf):
    reason = F.coalesce("reject_reason", F.lit("kept")).alias("reason")
    return judged_trips(spark, sf).groupBy("source_month", reason).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "c17_copy_rank",
    f"""{JUDGED_SQL} select trip_id, count(*) filter (where reject_reason is null) as kept,
      count(*) filter (where reject_reason = 'duplicate_row') as copies
    from judged group by trip_id having count(*) > 1""",
)
def copy_rank(spark, sf):
    return (
        judged_trips(spark, sf)
        .groupBy("trip_id")
        .agg(
            F.count_if(F.col("reject_reason").isNull()).alias("kept"),
            F.count_if(F.col("reject_reason") == "duplicate_row").alias("copies"),
            F.count(F.lit(1)).alias("_n"),
        )
        .filter("_n > 1")
        .drop("_n")
    )


FLAG_QUERIES = {
    "c18_zero_distance": "is_zero_distance",
    "c19_zero_duration": "is_zero_duration",
    "c20_long_duration": "is_long_duration",
    "c21_near_duplicate": "is_near_duplicate",
}


def _flag_query(name: str, flag: str) -> None:
    @query(
        name,
        f"""{JUDGED_SQL} select trip_id, {text('source_month')} from judged
        where {flag} and reject_reason is null""",
    )
    def flagged(spark, sf):
        kept = judged_trips(spark, sf).filter(F.col("reject_reason").isNull() & F.col(flag))
        return kept.select("trip_id", "source_month")


for _name, _flag in FLAG_QUERIES.items():
    _flag_query(_name, _flag)


@query(
    "c23_split_counts",
    f"""{JUDGED_SQL} select {text('source_month')}, count(*) as source_rows,
      count(*) filter (where reject_reason is null) as curated_rows,
      count(*) filter (where reject_reason is not null) as quarantined_rows
    from judged group by source_month""",
)
def split_counts(spark, sf):
    kept = F.col("reject_reason").isNull()
    return judged_trips(spark, sf).groupBy("source_month").agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(kept).alias("curated_rows"),
        F.count_if(~kept).alias("quarantined_rows"),
    )


@query(
    "d01_primary_counts",
    f"{JUDGED_SQL} select reject_reason, count(*) as rows from judged group by 1",
)
def primary_counts(spark, sf):
    return dq.primary_counts(judged_trips(spark, sf))


@query(
    "d02_rule_hits",
    f"""{JUDGED_SQL} select reason, count(*) as rows
    from (select unnest(reject_reasons) as reason from judged) group by 1""",
)
def rule_hits(spark, sf):
    return dq.rule_hits(judged_trips(spark, sf))


@query(
    "d03_null_passengers",
    f"""{JUDGED_SQL} select {text('source_month')},
      count(*) filter (where passenger_count is null) as passenger_count_null_rows
    from judged group by source_month""",
)
def null_passengers(spark, sf):
    return dq.month_reports(judged_trips(spark, sf)).select(
        F.col("month_start").alias("source_month"), "passenger_count_null_rows"
    )


@query(
    "d04_soft_flag_counts",
    f"""{JUDGED_SQL} select {text('source_month')}, {', '.join(
        f'count(*) filter (where {f}) as {f}' for f in FLAGS)}
    from (select * from judged where reject_reason is null) group by source_month
    union all select distinct {text('source_month')}, 0, 0, 0, 0 from judged
    where source_month not in (select source_month from judged where reject_reason is null)""",
)
def soft_flag_counts(spark, sf):
    reports = dq.month_reports(judged_trips(spark, sf))
    return reports.select(
        F.col("month_start").alias("source_month"),
        *[F.col("soft_flag_counts")[f].alias(f) for f in FLAGS],
    )


REPORT_SQL = f"""
    select {text('source_month')}, count(*) as source_rows,
      count(*) filter (where reject_reason is null) as curated_rows,
      count(*) filter (where reject_reason is not null) as quarantined_rows,
      round(count(*) filter (where reject_reason is not null)::double / count(*), 6)
        as quarantine_rate,
      {', '.join(f"count(*) filter (where reject_reason = '{c}') as first_{c}" for c in RULE_CODES)},
      {', '.join(f"count(*) filter (where list_contains(reject_reasons, '{c}')) as hit_{c}"
                 for c in RULE_CODES)},
      {', '.join(f'count(*) filter (where reject_reason is null and {f}) as {f}' for f in FLAGS)},
      count(*) filter (where passenger_count is null) as passenger_count_null_rows
    from judged group by source_month"""


def flat_reports(reports):
    zero = F.lit(0)
    return reports.select(
        F.col("month_start").alias("source_month"),
        "source_rows",
        "curated_rows",
        "quarantined_rows",
        "quarantine_rate",
        *[
            F.coalesce(F.col("reject_reason_counts")[c], zero).alias(f"first_{c}")
            for c in RULE_CODES
        ],
        *[F.coalesce(F.col("rule_hit_counts")[c], zero).alias(f"hit_{c}") for c in RULE_CODES],
        *[F.col("soft_flag_counts")[f].alias(f) for f in FLAGS],
        "passenger_count_null_rows",
    )


@query("d06_month_report", JUDGED_SQL + REPORT_SQL)
def month_report(spark, sf):
    return flat_reports(dq.month_reports(judged_trips(spark, sf)))


