"""Scans, sinks, commit protocol, resume and multi-month roll-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthlake.catalogue import fixture as fx
from monthlake.catalogue.fixture import JUDGED_SQL, RAW_SQL, TRIPS_SQL
from monthlake.catalogue.q_rules import REPORT_SQL, flat_reports
from monthlake.catalogue.registry import number, query, text
from monthlake.functions.contract import FLAGS
from monthlake.functions.months import Month, month_spine
from monthlake.operators import dq
from monthlake.plans import batch
from monthlake.session import configure, shared_folder
from monthlake.sources import lake, raw

_LAKES: dict[tuple[str, str], str] = {}


def built_lake(spark, sf) -> str:
    """Root of a lake with every month of the trips processed; built once per session and folder."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LAKES:
        root = shared_folder(spark, "lake")
        trips = fx.typed_trips(spark, sf)
        months = [
            Month(r.source_month) for r in trips.select("source_month").distinct().collect()
        ]
        batch.run_months(spark, trips, root, months)
        _LAKES[key] = root
    return _LAKES[key]


@query("a01_scan_count", "select count(*) as source_rows from lineitem")
def scan_count(spark, sf):
    return spark.read.parquet(f"{sf}/lineitem.parquet").agg(F.count(F.lit(1)).alias("source_rows"))


@query("a02_manifest")
def manifest(spark, sf):
    """Bytes, digest, rows and verdict of every file of the data set."""
    found = raw.manifest(raw.list_files(spark, sf))
    return found.select("period", "bytes", "sha256", "rows", "status")


@query("a03_schema_survey")
def schema_survey(spark, sf):
    """Column, physical type, and the files that have it."""
    return raw.schema_survey(raw.list_files(spark, sf))


@query("a03y_rows_by_file")
def rows_by_file(spark, sf):
    facts = raw.footers(raw.list_files(spark, sf))
    return facts.select(raw.file_period(F.col("path")).alias("period"), "rows")


CURATED = "trip_id, passenger_count, trip_distance, pu_location_id, do_location_id"


@query(
    "a05_curated_sink",
    f"""{JUDGED_SQL} select {CURATED}, {text('source_month', 'pickup_datetime')},
      {number('fare_amount', 'total_amount')}, {', '.join(FLAGS)}
    from judged where reject_reason is null""",
)
def curated_sink(spark, sf):
    rows = batch.curated(spark, built_lake(spark, sf))
    return rows.select(
        "trip_id", "passenger_count", "trip_distance", "pu_location_id", "do_location_id",
        "source_month", "pickup_datetime", "fare_amount", "total_amount", *FLAGS,
    )


@query(
    "a06_quarantine_sink",
    f"""{JUDGED_SQL} select trip_id, {text('source_month')}, {number('total_amount')},
      reject_reason, array_to_string(reject_reasons, ',') as reject_reasons
    from judged where reject_reason is not null""",
)
def quarantine_sink(spark, sf):
    rows = batch.quarantine(spark, built_lake(spark, sf))
    return rows.select("trip_id", "source_month", "total_amount", "reject_reason", "reject_reasons")


@query(
    "a08_reconcile",
    f"""{JUDGED_SQL} select count(*) as source_rows,
      count(*) filter (where reject_reason is null) as curated_rows,
      count(*) filter (where reject_reason is not null) as quarantined_rows, true as reconciled
    from judged""",
)
def reconcile(spark, sf):
    root = built_lake(spark, sf)
    rows = F.count(F.lit(1))
    curated = batch.curated(spark, root).agg(rows).scalar().alias("curated_rows")
    bad = batch.quarantine(spark, root).agg(rows).scalar().alias("quarantined_rows")
    source = fx.lineitem_trips(spark, sf).agg(rows.alias("source_rows"))
    total = F.col("curated_rows") + F.col("quarantined_rows")
    return source.select("source_rows", curated, bad).withColumn(
        "reconciled", F.col("source_rows") == total
    )


@query("a09_report_marker", JUDGED_SQL + REPORT_SQL)
def report_marker(spark, sf):
    """The reports as written last by the monthly job."""
    return flat_reports(batch.reports(spark, built_lake(spark, sf)))


@query(
    "a04_layout",
    f"""{JUDGED_SQL} select strftime(source_month, '%Y') as year, strftime(source_month, '%m') as
      month, count(*) as rows
    from judged where reject_reason is null group by all""",
)
def layout(spark, sf):
    """Directories of the curated zone are the month of their rows."""
    rows = batch.curated(spark, built_lake(spark, sf))
    return rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "a10_partition_swap",
    f"""{TRIPS_SQL} select {text('source_month')}, count(*) as n,
      cast(sum(total_amount) as double) as total_amount
    from trips where source_month != date '1998-06-01' or payment_type = 1
    group by source_month""",
)
def partition_swap(spark, sf):
    """One month is replaced by its card trips; every other month stays as it was."""
    path = shared_folder(spark, "swap")
    trips = fx.typed_trips(spark, sf).select("source_month", "payment_type", "total_amount")
    lake.swap_partitions(trips, path, ["source_month"])
    month = F.col("source_month") == F.lit("1998-06-01").cast("date")
    lake.swap_partitions(trips.filter(month & (F.col("payment_type") == 1)), path, ["source_month"])
    return lake.read_table(spark, path).groupBy("source_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("total_amount")
    )


@query(
    "a11_clear_partition",
    f"""{RAW_SQL} select {text('source_month')}, count(*) as n from raw_trips
    where source_month != date '1998-06-01' group by source_month""",
)
def clear_partition(spark, sf):
    path = shared_folder(spark, "clear")
    lake.swap_partitions(fx.typed_trips(spark, sf).select("source_month", "vendor_id"), path, ["source_month"])
    lake.clear_partition(spark, path, source_month="1998-06-01")
    return lake.read_table(spark, path).groupBy("source_month").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a12_load_verify",
    f"""{JUDGED_SQL} select {text('month_start')}, expected_rows, 0::bigint as loaded_rows
    from (select source_month as month_start, count(*) as expected_rows from judged
      where reject_reason is null group by 1) where month(month_start) = 1""",
)
def load_verify(spark, sf):
    """A load that lost every January: exactly those months are reported."""
    root = built_lake(spark, sf)
    loaded = batch.curated(spark, root).filter(F.month("source_month") != 1)
    return lake.verify_load(batch.reports(spark, root), loaded, "curated_rows")


def _counts(spark, sf):
    root = built_lake(spark, sf)
    return lake.partition_counts(
        {"curated": batch.curated(spark, root), "quarantine": batch.quarantine(spark, root)}
    )


COUNTS_SQL = """counts as (
  select case when reject_reason is null then 'curated' else 'quarantine' end as table_name,
    source_month as "partition", count(*) as rows from judged group by all)"""


@query(
    "a13_partition_counts",
    f"""{JUDGED_SQL}, {COUNTS_SQL} select table_name, cast("partition" as varchar) as "partition",
    rows from counts""",
)
def partition_counts(spark, sf):
    return _counts(spark, sf)


@query(
    "a14_resume_decision",
    f"""{JUDGED_SQL}, {COUNTS_SQL},
    held as (select * from counts where not (table_name = 'curated' and month("partition") = 1)
      and not (table_name = 'quarantine' and month("partition") = 2)),
    reported as (select source_month, count(*) filter (where reject_reason is null) as c,
      count(*) filter (where reject_reason is not null) as q from judged group by 1)
    select {text('source_month').replace(' as source_month', ' as month_start')},
      c as curated_rows, q as quarantined_rows,
      coalesce((select rows from held where table_name = 'curated' and "partition" = source_month)
        = c, false)
      and coalesce((select rows from held where table_name = 'quarantine'
        and "partition" = source_month), 0) = q as done
    from reported""",
)
def resume_decision(spark, sf):
    """Tables that miss Januaries (curated) and Februaries (quarantine): those months are not done."""
    lost = ((F.col("table_name") == "curated") & (F.month("partition") == 1)) | (
        (F.col("table_name") == "quarantine") & (F.month("partition") == 2)
    )
    reported = batch.reports(spark, built_lake(spark, sf))
    return lake.done_months(reported, _counts(spark, sf).filter(~lost), "curated", "quarantine")


@query(
    "a15_month_spine",
    f"""{RAW_SQL}, spine as (
      select cast(unnest(generate_series(lo, hi, interval 1 month)) as date) as month_start
      from (select cast(min(source_month) as timestamp) as lo, cast(max(source_month) as timestamp)
        as hi from raw_trips))
    select {text('month_start')}, coalesce(n, 0) as rows from spine
    left join (select source_month, count(*) as n from raw_trips group by 1)
      on source_month = month_start""",
)
def months(spark, sf):
    """Every month between the first and the last, with its rows (0 where the source has none)."""
    trips = fx.lineitem_trips(spark, sf).select(F.col("_source_month").alias("month_start"))
    bounds = trips.agg(F.min("month_start").alias("first"), F.max("month_start").alias("last"))
    counts = trips.groupBy("month_start").agg(F.count(F.lit(1)).alias("rows"))
    spine = month_spine(bounds, "first", "last")
    return spine.join(counts, "month_start", "left").withColumn(
        "rows", F.coalesce("rows", F.lit(0))
    )


@query(
    "a16_backfill_rollup",
    f"""{JUDGED_SQL} select 'reason' as kind, reject_reason as name, count(*) as rows from judged
      where reject_reason is not null group by 2
    union all {' union all '.join(
        f"select 'flag', '{f}', count(*) filter (where reject_reason is null and {f}) from judged"
        for f in FLAGS)}""",
)
def backfill_rollup(spark, sf):
    return dq.rollup_counts(batch.reports(spark, built_lake(spark, sf)))


@query(
    "a16t_backfill_totals",
    f"""{JUDGED_SQL} select count(distinct source_month) as months, count(*) as source_rows,
      count(*) filter (where reject_reason is null) as curated_rows,
      count(*) filter (where reject_reason is not null) as quarantined_rows,
      round(count(*) filter (where reject_reason is not null)::double / count(*), 6)
        as quarantine_rate
    from judged""",
)
def backfill_totals(spark, sf):
    return dq.rollup_totals(batch.reports(spark, built_lake(spark, sf)))


@query(
    "a17_seed_scan",
    """select p_partkey as location_id, p_brand as borough, p_name as zone_name,
      case when p_size > 25 then 'N/A' else p_type end as service_zone from part""",
)
def seed_scan(spark, sf):
    """Parts written as a CSV lookup and read back with declared types; 'N/A' stays text."""
    path = shared_folder(spark, "seed")
    part = spark.read.parquet(f"{sf}/part.parquet")
    part.select(
        F.col("p_partkey").alias("location_id"),
        F.col("p_brand").alias("borough"),
        F.col("p_name").alias("zone_name"),
        F.when(F.col("p_size") > 25, "N/A").otherwise(F.col("p_type")).alias("service_zone"),
    ).write.option("header", True).csv(path)
    from monthlake.plans.star import ZONE_SCHEMA

    return raw.read_seed(spark, path, ZONE_SCHEMA)


@query(
    "a22_window_extract",
    f"""{RAW_SQL} select {text('tpep_pickup_datetime', 'tpep_dropoff_datetime')},
      "VendorID" as vendor_id, "PULocationID" as pu_location_id
    from raw_trips where tpep_dropoff_datetime >= timestamp '1998-06-08 00:00:00'
      and tpep_dropoff_datetime < timestamp '1998-06-08 00:00:00' + interval 10080 minutes""",
)
def window_extract(spark, sf):
    trips = raw.ended_within(
        fx.lineitem_trips(spark, sf), "1998-06-08 00:00:00", 7 * 24 * 60, "tpep_dropoff_datetime"
    )
    return trips.select(
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        F.col("VendorID").alias("vendor_id"),
        F.col("PULocationID").alias("pu_location_id"),
    )


