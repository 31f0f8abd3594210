"""Headline timings as one JSON line: the monthly job, the fact, marts, reports, stream, profiling.

Inputs: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Marts run over the
written fact, as in service. Each step is timed once, to the end of its write or to its last row.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from monthlake.catalogue import fixture as fx
from monthlake.functions.months import Month
from monthlake.operators import checks, profile
from monthlake.operators.classify import classify
from monthlake.plans import batch, marts, reports, star
from monthlake.session import build_session, shared_folder
from monthlake.sources import lake
from monthlake.streaming import ingest, views


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def step(name, work):
        start = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    run(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())  # JVM warm-up
    # The raw months as files of the landing zone, so the job below starts from a scan.
    landing = shared_folder(spark, "landing")
    fx.typed_trips(spark, sf).repartition(int(cpus)).write.parquet(landing)
    trips = spark.read.parquet(landing)
    rows = trips.count()
    months = [Month(r.source_month) for r in trips.select("source_month").distinct().collect()]
    root, fact_path, flow_path = (shared_folder(spark, p) for p in ("lake", "fact", "flows"))

    step("classify", lambda: run(classify(trips)))
    step("monthly_job", lambda: batch.run_months(spark, trips, root, months).count())
    reported = batch.reports(spark, root)
    curated = batch.committed(batch.curated(spark, root), reported).drop("year", "month")
    step("fact_build", lambda: star.build_fact(spark, curated, fact_path))
    fact = lake.read_table(spark, fact_path)
    zones, days = star.dim_zone(fx.zones(spark, sf)), fx.days(spark)
    step("g01_daily", lambda: run(marts.daily_metrics(fact)))
    step("g02_hourly", lambda: run(marts.hourly_demand(fact)))
    step("g03_zone_flows", lambda: marts.build_zone_flows(spark, fact, flow_path))
    flows = lake.read_table(spark, flow_path)
    step("g05_airport", lambda: run(marts.airport_trips(fact, zones)))
    step("h01_daily_overview", lambda: run(reports.daily_overview(marts.daily_metrics(fact), days)))
    step("h02_hourly_profile", lambda: run(reports.hourly_profile(marts.hourly_demand(fact), days)))
    named = reports.zone_flows_named(flows, zones)
    step("h03_zone_flows_named", lambda: run(named))
    step("h04_borough_flows", lambda: run(reports.borough_flows(named)))
    step("h08_yearly", lambda: run(reports.yearly_summary(marts.daily_metrics(fact))))
    step("j02_trip_id_unique", lambda: run(checks.unique(fact, "trip_id")))
    inbox, table, state = (shared_folder(spark, p) for p in ("inbox", "deliveries", "state"))
    fx.envelopes(spark, sf).repartition(int(cpus)).write.json(inbox)
    step(
        "stream_ingest",
        lambda: ingest.start_ingest(ingest.json_source(spark, inbox), table, state).awaitTermination(),
    )
    # The look for hot trips is part of the time.
    step("i04_judged_events", lambda: run(views.judged_events(ingest.delivered(spark, table))))
    mark = star.stored_mark(spark, fact_path)

    def unified():
        return views.fact_unified(fact, views.fact_live(views.judged_events(ingest.delivered(spark, table))), mark)

    step("i06_unified", lambda: run(unified()))
    step("k01_profile", lambda: run(profile.profile(trips)))
    step("k05_twins", lambda: run(profile.twin_summary(trips, "all money")))
    step("k09_speed", lambda: run(profile.speed_counts(trips)))
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": sf.rsplit("sf", 1)[-1],
                "rows": rows,
                "monthly_job_rows_per_sec": round(rows / times["monthly_job"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
