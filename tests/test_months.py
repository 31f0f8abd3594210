"""Reconciling by write metrics, pruned months, stored footers, eras by pattern, stored sketches, live plans."""

import os
from datetime import date, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_lake import MAY, mixed_month, run
from test_stream import deliveries
from trips import RIDE, era, trip, typed, write

from monthlake.functions.months import Month
from monthlake.operators import profile, sketches
from monthlake.operators.skew import HotPolicy
from monthlake.plans import batch
from monthlake.sources import lake, raw
from monthlake.streaming import views


def plan(df):
    return df._jdf.queryExecution().toString()


# ---------------------------------------------------------------- reconcile


@pytest.mark.parametrize("read_back", [False, True])
def test_both_ways_of_reconciling_find_a_wrong_count(spark, tmp_path, monkeypatch, read_back):
    real = lake.swap_partitions

    def loses_a_row(df, path, *args, **kwargs):
        lost = df.limit(df.count() - 1) if path.endswith("curated") else df
        return real(lost, path, *args, **kwargs)

    monkeypatch.setattr(batch.lake, "swap_partitions", loses_a_row)
    with pytest.raises(batch.ReconciliationError, match=r"2021-05: source 15, counted \(8, 7\), written \(7, 7\)"):
        batch.run_months(spark, typed(spark, mixed_month(), tmp_path), str(tmp_path / "lake"), [MAY], read_back=read_back)


def test_outputs_are_not_read_again(spark, tmp_path, monkeypatch):
    for name in ("curated", "quarantine"):
        monkeypatch.setattr(batch, name, lambda *_: pytest.fail("a zone was read"))
    report = run(spark, tmp_path, mixed_month()).collect()[0]
    assert (report.curated_rows, report.quarantined_rows) == (8, 7)


def test_a_write_tells_what_it_wrote(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    told = lake.swap_partitions(rows, str(tmp_path / "t"), ["k"], observed={"all": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)})
    assert told == {"all": 1000, "odd": 500}
    assert lake.swap_partitions(rows, str(tmp_path / "t"), ["k"]) == {}


# ---------------------------------------------------------------- committed months


def test_committed_months_prune_directories_at_run_time(spark, tmp_path):
    root = str(tmp_path / "lake")
    frames = []
    for m in range(1, 7):
        when = datetime(2021, m, 3)
        rows = [trip(tpep_pickup_datetime=when, tpep_dropoff_datetime=when + RIDE, DOLocationID=m)]
        frames.append(typed(spark, rows, tmp_path / f"m{m}", f"2021-{m:02d}-01"))
    both = frames[0]
    for f in frames[1:]:
        both = both.unionByName(f)
    months = [Month.of(f"2021-{m:02d}") for m in range(1, 7)]
    batch.run_months(spark, both, root, months)
    reported = batch.reports(spark, root).filter(F.col("month_start") == F.lit(date(2021, 4, 1)))
    rows = batch.committed(batch.curated(spark, root), reported)
    assert [(r.do_location_id, r.month) for r in rows.collect()] == [(4, "04")]
    assert "dynamicpruning" in plan(rows).lower()
    assert batch.committed(batch.quarantine(spark, root), batch.reports(spark, root), "quarantined_rows").count() == 0


# ---------------------------------------------------------------- footers and eras


def some_files(folder, n, first=date(2009, 1, 1)):
    folder.mkdir(parents=True, exist_ok=True)
    table = era([trip()])
    for i in range(n):
        pq.write_table(table, folder / f"t_{first.year + i // 12}-{i % 12 + 1:02d}_{i:04d}.parquet")


def test_old_footers_are_not_read_again(spark, tmp_path):
    folder, store = tmp_path / "raw", str(tmp_path / "store")
    some_files(folder, 1000)
    facts = raw.stored_footers(spark, str(folder), store)
    assert facts.count() == 1000 and facts.filter("rows = 1").count() == 1000
    for path in folder.iterdir():  # same size and time, other bytes: only a read would notice
        stat = path.stat()
        path.write_bytes(b"x" * stat.st_size)
        os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    write(era([trip(), trip()]), folder / "t_1999-01.parquet")
    facts = raw.stored_footers(spark, str(folder), store)
    assert facts.count() == 1001 and facts.filter("rows is null").count() == 0
    assert [r.rows for r in facts.filter("path like '%1999-01%'").collect()] == [2]
    assert spark.read.parquet(store).count() == 1001


def test_changed_and_deleted_files(spark, tmp_path):
    folder, store = tmp_path / "raw", str(tmp_path / "store")
    some_files(folder, 3)
    raw.stored_footers(spark, str(folder), store)
    names = sorted(folder.iterdir())
    names[0].unlink()
    write(era([trip()] * 4), names[1])
    got = {Path(r.path).name: r.rows for r in raw.stored_footers(spark, str(folder), store).collect()}
    assert got == {names[1].name: 4, names[2].name: 1}


def test_garbled_footers_are_verdicts(spark, tmp_path):
    """Whole magic bytes around a footer that cannot be parsed; a length beyond the file; magic bytes alone."""
    good = Path(write(era([trip()]), tmp_path / "t_2019-01.parquet")).read_bytes()
    size = int.from_bytes(good[-8:-4], "little")
    garbled = good[: -8 - size] + bytes(255 - b for b in good[-8 - size : -8]) + good[-8:]
    cases = {"02": garbled, "03": good[:-8] + (1 << 30).to_bytes(4, "little") + b"PAR1", "05": b"PAR1", "06": b"PAR1PAR1"}
    for month, data in cases.items():
        (tmp_path / f"t_2019-{month}.parquet").write_bytes(data)
    got = {r.period: r.status for r in raw.manifest(raw.list_files(spark, str(tmp_path))).collect()}
    assert got == {"2019-01": "ok"} | {f"2019-{m}": "unreadable" for m in cases}
    with pytest.raises(raw.UnreadableFiles, match="2019-02"):
        raw.read_months(spark, str(tmp_path), processed_at=datetime(2025, 1, 1))


def test_eras_are_read_by_months(spark, tmp_path):
    """Two eras, one month that holds files of both, files in sub-folders, and known footers."""
    folder = tmp_path / "raw"
    write(era([trip()]), folder / "t_2021-05.parquet")
    write(era([trip(), trip()]), folder / "more" / "t_2021-06_a.parquet")
    write(era([trip()] * 3, new=True), folder / "t_2021-06_b.parquet")
    write(era([trip()] * 4, new=True), folder / "more" / "t_2021-07.parquet")
    want = {"2021-05-01": 1, "2021-06-01": 5, "2021-07-01": 4}

    def months(rows):
        return {str(r.source_month): r["count"] for r in rows.groupBy("source_month").count().collect()}

    clock = datetime(2025, 1, 1)
    assert months(raw.read_months(spark, str(folder), processed_at=clock)) == want
    facts = raw.stored_footers(spark, str(folder), str(tmp_path / "store"))
    assert months(raw.read_months(spark, str(folder), processed_at=clock, facts=facts)) == want
    files = raw.list_files(spark, str(folder)).filter("path like '%2021-06%'")
    assert months(raw.read_months(spark, str(folder), processed_at=clock, files=files, facts=facts)) == {"2021-06-01": 5}
    report = batch.run_folder(spark, str(folder), str(tmp_path / "lake"), [MAY], processed_at=clock).collect()[0]
    assert report.source_file == "t_2021-05.parquet" and report.source_rows == 1


# ---------------------------------------------------------------- sketches


def test_sketches_of_a_range(spark, tmp_path):
    """Exact ranks confirm the bound; months outside the range, and months sketched before, take no part."""
    path = str(tmp_path / "sketches")
    rows = spark.range(60_000).select(
        F.expr("add_months(date '2020-01-01', cast(id % 6 as int))").alias("source_month"),
        F.timestamp_seconds(1577836800 + F.col("id")).cast("timestamp_ntz").alias("pickup_datetime"),
        (F.abs(F.hash("id")) % 4000).alias("secs_"),
        (F.pmod(F.xxhash64("id"), F.lit(20_000)) / 1000).alias("trip_distance"),
        (F.col("id") % 90).cast("decimal(15,2)").alias("fare_amount"),
    )
    trips = rows.withColumn("dropoff_datetime", F.expr("timestampadd(SECOND, cast(secs_ as int), pickup_datetime)")).drop("secs_")
    sketches.store(trips, path)
    first, last = date(2020, 2, 1), date(2020, 5, 1)
    points = [0.01, 0.5, 0.99, 0.999]
    found = sketches.quantiles(spark, path, points, first, last)
    some = trips.filter(lake.within(F.col("source_month"), first, last))
    errors = sketches.rank_errors(some, found).collect()
    assert len(errors) == 16 and {r.n for r in errors if r.measure == "miles"} == {30_000}
    assert max(r.rank_error for r in errors) <= sketches.RANK_ERROR
    before = {r.source_month: r.sketch for r in lake.read_table(spark, path).filter("measure = 'miles'").collect()}
    april = trips.filter("source_month = date '2020-04-01'").withColumn("trip_distance", F.lit(3.0))
    sketches.store(april, path)
    after = {r.source_month: r.sketch for r in lake.read_table(spark, path).filter("measure = 'miles'").collect()}
    assert {m for m in before if before[m] != after[m]} == {date(2020, 4, 1)}
    only = sketches.quantiles(spark, path, [0.5], date(2020, 4, 1), last).filter("measure = 'miles'").collect()
    assert [(r.n, r.value) for r in only] == [(10_000, 3.0)]


def test_limits_of_the_profile_are_its_own():
    assert profile.COUNTED["minutes"][2] == (180, 360, 1440) and profile.COUNTED["total_amount"][2] == (1000, 10000)


# ---------------------------------------------------------------- live views


@pytest.fixture()
def live(spark, tmp_path):
    rows = [trip(), trip(tip_amount=4.0), trip(tip_amount=5.0), trip(), trip(VendorID=7), trip(fare_amount=-3.0), trip(fare_amount=-3.0, tip_amount=1.0)]
    return deliveries(spark, tmp_path, rows, [f"18:00:0{i}" for i in range(7)])


def test_both_routes_flag_the_same_events(spark, live):
    want = {r.message_id: (r.reject_reason, r.is_near_duplicate) for r in views.judged_events(live, None).collect()}
    assert sorted(m for m, (_, twin) in want.items() if twin) == ["m0", "m1", "m2"]
    for policy in (HotPolicy(min_rows=1), HotPolicy(min_rows=3), HotPolicy()):
        assert {r.message_id: (r.reject_reason, r.is_near_duplicate) for r in views.judged_events(live, policy).collect()} == want


def test_one_exchange_for_events_and_one_for_twins(live):
    text = views.judged_events(live, None)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2
    assert "WindowGroupLimit" in text and "SortAggregate" not in text


def test_recent_days_alone_are_opened(spark, live, tmp_path):
    path = str(tmp_path / "days")
    for back in range(40):
        shifted = live.withColumn("publish_time", F.col("publish_time") - F.expr(f"interval {back} days"))
        shifted.withColumn("publish_date", F.to_date("publish_time")).coalesce(1).write.mode("append").partitionBy("publish_date").parquet(path)
    as_of = F.lit("2024-06-14 18:30:00").cast("timestamp")
    recent = views.published_within(spark.read.parquet(path), as_of, "60 minutes")
    files = {r[0] for r in recent.select(F.col("_metadata.file_path")).distinct().collect()}
    assert len(files) == 2 and "publish_date" not in recent.columns
    assert "PartitionFilters: [isnotnull(publish_date" in recent._jdf.queryExecution().explainString(
        recent.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
