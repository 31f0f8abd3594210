from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from trips import MONTH, RIDE, START, era, lasting, refund, trip, typed, write

from monthlake.functions.contract import TRIPS, ContractViolation
from monthlake.functions.months import Month, month_path, month_spine
from monthlake.operators import dq
from monthlake.plans import batch, star
from monthlake.sources import fs, lake, raw

MAY = Month.of("2021-05")


def mixed_month():
    """Rows of every fate: 8 kept (two of them flagged), 7 rejected in five ways."""
    kept = [trip(DOLocationID=z) for z in range(20, 26)]
    kept += [trip(DOLocationID=30, trip_distance=0.0, passenger_count=None), trip(DOLocationID=31, passenger_count=None)]
    paid = trip(DOLocationID=40)
    return [
        *kept, kept[1], kept[1], paid, refund(paid), trip(DOLocationID=999),
        lasting(-RIDE, DOLocationID=41, trip_distance=0.0),
        trip(DOLocationID=42, tpep_pickup_datetime=MONTH - RIDE),
    ]


def run(spark, tmp_path, rows):
    return batch.run_months(spark, typed(spark, rows, tmp_path), str(tmp_path / "lake"), [MAY])


def test_month_arithmetic_and_layout():
    assert str(Month.of("2019-12").plus(1)) == "2020-01"
    assert str(Month.of("2019-01").plus(-1)) == "2018-12"
    assert Month.of("2019-02") < Month.of("2019-10")
    assert month_path("/lake/", "curated", MAY) == "/lake/curated/year=2021/month=05"
    for bad in ("2019-1", "2019-13", "201901"):
        with pytest.raises(ValueError):
            Month.of(bad)


def test_month_spine(spark):
    bounds = spark.createDataFrame([(date(2019, 11, 5), date(2020, 2, 1))], "a date, b date")
    got = [str(r.month_start) for r in month_spine(bounds, "a", "b").collect()]
    assert got == ["2019-11-01", "2019-12-01", "2020-01-01", "2020-02-01"]
    with pytest.raises(Exception, match="backwards"):
        month_spine(bounds, "b", "a").collect()


def test_report_accounts_for_every_row(spark, tmp_path):
    rows = mixed_month()
    report = run(spark, tmp_path, rows).collect()[0]
    assert (report.source_rows, report.curated_rows, report.quarantined_rows) == (len(rows), 8, 7)
    assert report.quarantine_rate == round(7 / len(rows), 6)
    assert sum(report.reject_reason_counts.values()) == 7
    assert {k: v for k, v in report.reject_reason_counts.items() if v > 1} == {"duplicate_row": 2}
    assert report.passenger_count_null_rows == 2 and report.source_file is None
    assert {k for k, v in report.soft_flag_counts.items() if v} == {"is_zero_distance"}


def test_each_month_has_its_own_clock(spark, tmp_path):
    june = typed(spark, [trip()], tmp_path / "b", "2021-06-01").withColumn(
        "processed_at", F.lit("2025-07-08 00:00:00").cast("timestamp")
    )
    both = typed(spark, mixed_month(), tmp_path / "a").unionByName(june)
    got = batch.run_months(spark, both, str(tmp_path / "lake"), [MAY, Month.of("2021-06")]).collect()
    assert {str(r.month_start): r.processed_at for r in got} == {
        "2021-05-01": datetime(2025, 3, 4, 5, 6, 7), "2021-06-01": datetime(2025, 7, 8),
    }


def test_rerun_replaces_and_other_months_stay(spark, tmp_path):
    root = str(tmp_path / "lake")
    when = datetime(2021, 4, 3)
    april = typed(spark, [trip(tpep_pickup_datetime=when, tpep_dropoff_datetime=when + RIDE)], tmp_path / "b", "2021-04-01")
    batch.run_months(spark, april, root, [Month.of("2021-04")])
    run(spark, tmp_path, mixed_month())
    run(spark, tmp_path, mixed_month())
    ids = [r.trip_id for r in batch.curated(spark, root).collect()]
    assert len(ids) == len(set(ids)) == 9
    assert batch.reports(spark, root).count() == 2


def test_month_without_kept_or_rejected_rows_clears_old_partitions(spark, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, tmp_path, mixed_month())
    run(spark, tmp_path, [trip()])
    assert batch.quarantine(spark, root).count() == 0
    run(spark, tmp_path, [trip(PULocationID=0)])
    assert batch.curated(spark, root).count() == 0
    assert batch.quarantine(spark, root).count() == 1


def test_failed_run_removes_the_report(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    run(spark, tmp_path, mixed_month())
    monkeypatch.setattr(batch, "_reconcile", lambda *a: (_ for _ in ()).throw(batch.ReconciliationError("x")))
    with pytest.raises(batch.ReconciliationError):
        run(spark, tmp_path, mixed_month())
    assert not fs.exists(spark, month_path(root, "reports", MAY))
    left = batch.reports(spark, root)
    assert batch.committed(batch.curated(spark, root), left).count() == 0
    with pytest.raises(lake.LoadMismatch, match="no report"):
        batch.load_months(spark, root, str(tmp_path / "wh"), [MAY])


def test_reconcile_names_the_month():
    with pytest.raises(batch.ReconciliationError, match="2021-05"):
        batch._reconcile([MAY], {MAY.first: 3}, {}, {"curated": {}, "quarantine": {}})


def test_files_hold_the_declared_types(spark, tmp_path):
    run(spark, tmp_path, mixed_month())
    kinds = {
        "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "date": pa.date32(),
        "decimal(15,2)": pa.decimal128(15, 2), "timestamp_ntz": pa.timestamp("us"), "timestamp": pa.timestamp("us", "UTC"),
    }
    for zone, declared in (("curated", TRIPS.curated_schema()), ("quarantine", TRIPS.quarantine_schema())):
        file = pq.ParquetFile(next(Path(month_path(str(tmp_path / "lake"), zone, MAY)).glob("*.parquet")))
        assert file.schema_arrow.names == [n for n, _ in declared]
        for name, kind in declared:
            if kind in kinds:
                assert file.schema_arrow.field(name).type == kinds[kind], name
        # Instants and wall clocks are 64-bit integers, never the 96-bit form.
        stored = {file.schema.column(i).name: file.schema.column(i).physical_type for i in range(len(file.schema))}
        assert {stored[n] for n, k in declared if k.startswith("timestamp")} == {"INT64"}


def test_one_month_opens_one_directory(spark, tmp_path):
    root = str(tmp_path / "lake")
    for m in ("2021-05", "2021-06"):
        rows = typed(spark, [trip()], tmp_path / m, f"{m}-01")
        batch.run_months(spark, rows, root, [Month.of(m)])
    zone = batch.quarantine(spark, root).filter(batch.in_directories([Month.of("2021-06")]))
    plan = zone._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and zone.count() == 1


def test_load_swaps_and_verifies(spark, tmp_path):
    root, warehouse = str(tmp_path / "lake"), str(tmp_path / "wh")
    run(spark, tmp_path, mixed_month())
    batch.load_months(spark, root, warehouse, [MAY])
    batch.load_months(spark, root, warehouse, [MAY])
    assert lake.read_table(spark, f"{warehouse}/trips").count() == 8
    assert lake.read_table(spark, f"{warehouse}/trips_quarantine").count() == 7
    run(spark, tmp_path, [trip()])
    batch.load_months(spark, root, warehouse, [MAY])
    assert lake.read_table(spark, f"{warehouse}/trips").count() == 1
    assert fs.child_dirs(spark, f"{warehouse}/trips_quarantine") == []


@pytest.mark.parametrize("said", [(61, 0), (61, 5), (0, 5)])
def test_month_is_done_only_when_tables_equal_its_report(spark, said):
    """Against the rule in words, over what the tables may hold (None: no partition)."""
    reports = spark.createDataFrame([(MAY.first, *said)], "month_start date, curated_rows long, quarantined_rows long")
    for kept in (None, 0, 60, 61):
        for bad in (None, 4, 5):
            held = [(t, MAY.first, n) for t, n in (("good", kept), ("bad", bad)) if n is not None]
            counts = spark.createDataFrame(held, "table_name string, partition date, rows long")
            got = lake.done_months(reports, counts, "good", "bad").collect()
            assert [r.done for r in got] == [kept == said[0] and (bad or 0) == said[1]]


def test_rollup(spark, tmp_path):
    reports = run(spark, tmp_path, mixed_month())
    twice = reports.unionByName(reports)
    counts = {(r.kind, r["name"]): r.rows for r in dq.rollup_counts(twice).collect()}
    assert counts["reason", "duplicate_row"] == 4
    total = dq.rollup_totals(twice).collect()[0]
    assert (total.source_rows, total.quarantine_rate) == (30, round(14 / 30, 6))
    assert dq.rollup_totals(reports.limit(0)).collect()[0].quarantine_rate == 0.0


def test_read_months_of_two_eras(spark, tmp_path):
    folder = tmp_path / "raw"
    write(era([trip()]), folder / "year=2019" / "trips_2019-01.parquet")
    write(era([trip(), trip(PULocationID=2)], new=True), folder / "year=2023" / "trips_2023-03.parquet")
    clock = F.lit("2026-01-01").cast("timestamp")
    got = raw.read_months(spark, str(folder), processed_at=clock)
    months = {str(r.source_month): r["count"] for r in got.groupBy("source_month").count().collect()}
    assert months == {"2019-01-01": 1, "2023-03-01": 2}
    survey = {(r.column, r.type): (r.files, r.first_period) for r in raw.schema_survey(raw.list_files(spark, str(folder))).collect()}
    assert survey["VendorID", "int32"] == (1, "2023-03")
    assert survey["VendorID", "int64"] == (1, "2019-01")
    years = {r.year: r.rows for r in raw.rows_by_year(raw.list_files(spark, str(folder))).collect()}
    assert years == {"2019": 1, "2023": 2}
    bad = era([trip()]).append_column("surprise", pa.array([1.0]))
    write(bad, folder / "trips_2024-01.parquet")
    with pytest.raises(ContractViolation, match="surprise"):
        raw.read_months(spark, str(folder), processed_at=clock)


def test_broken_month_cannot_be_loaded(spark, tmp_path):
    """A month was committed; then its file is replaced by one that breaks the contract."""
    folder, root, wh = (str(tmp_path / n) for n in ("raw", "lake", "wh"))
    clock = F.lit("2025-01-01").cast("timestamp")
    june = Month.of("2021-06")
    write(era(mixed_month()), tmp_path / "raw" / "t_2021-05.parquet")
    write(era([trip(tpep_pickup_datetime=datetime(2021, 6, 2), tpep_dropoff_datetime=datetime(2021, 6, 2, 1))]), tmp_path / "raw" / "t_2021-06.parquet")
    first = batch.backfill(spark, folder, root, wh, [MAY, june], processed_at=clock)
    assert [r.status for r in first.collect()] == ["loaded", "loaded"]
    said = {r.month_start: r.source_file for r in batch.reports(spark, root).collect()}
    assert said == {MAY.first: "t_2021-05.parquet", june.first: "t_2021-06.parquet"}
    again = batch.backfill(spark, folder, root, wh, [MAY, june], processed_at=clock)
    assert [r.status for r in again.collect()] == ["skipped", "skipped"]
    write(era([trip()]).append_column("odd", pa.array([1])), tmp_path / "raw" / "t_2021-05.parquet")
    with pytest.raises(ContractViolation):
        batch.run_folder(spark, folder, root, [MAY], processed_at=clock)
    assert batch.reports(spark, root).count() == 1
    with pytest.raises(lake.LoadMismatch, match="no report"):
        batch.load_months(spark, root, wh, [MAY])
    july = Month.of("2021-07")
    write(era([trip(tpep_pickup_datetime=datetime(2021, 7, 2), tpep_dropoff_datetime=datetime(2021, 7, 2, 1))]), tmp_path / "raw" / "t_2021-07.parquet")
    rows = batch.backfill(spark, folder, root, wh, [MAY, june, july], processed_at=clock).collect()
    assert [r.status for r in rows] == ["failed", "skipped", "loaded"]
    assert "odd" in rows[0].error and rows[1].error is None


def test_manifest_tells_broken_files_apart(spark, tmp_path):
    import hashlib

    good = Path(write(era([trip()]), tmp_path / "t_2019-01.parquet"))
    write(era([]), tmp_path / "t_2019-02.parquet")
    (tmp_path / "t_2019-03.parquet").write_bytes(good.read_bytes()[:-20])
    (tmp_path / "t_2019-04.parquet").write_bytes(b"<html>not parquet</html>")
    got = {r.period: r for r in raw.manifest(raw.list_files(spark, str(tmp_path))).collect()}
    assert {p: r.status for p, r in got.items()} == {
        "2019-01": "ok", "2019-02": "empty", "2019-03": "unreadable", "2019-04": "unreadable",
    }
    assert got["2019-01"].sha256 == hashlib.sha256(good.read_bytes()).hexdigest()
    assert got["2019-01"].bytes == good.stat().st_size


def test_seed_keeps_text_na(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("location_id,borough,zone_name,service_zone\n264,Unknown,N/A,N/A\n")
    row = raw.read_seed(spark, str(path), star.ZONE_SCHEMA).collect()[0]
    assert (row.location_id, row.zone_name, row.service_zone) == (264, "N/A", "N/A")


def test_window_extract_is_half_open(spark, tmp_path):
    ends = [START + timedelta(minutes=m) for m in (50, 30, 49)]
    rows = [trip(tpep_dropoff_datetime=e) for e in ends]
    df = spark.read.parquet(write(era(rows), tmp_path / "w.parquet"))
    got = raw.ended_within(df, "2021-05-11 15:00:00", 20, "tpep_dropoff_datetime")
    assert [r.tpep_dropoff_datetime.minute for r in got.collect()] == [0, 19]


def test_expire_days(spark, tmp_path):
    days = spark.createDataFrame([(date(2024, 1, 1), 1), (date(2024, 3, 31), 2)], "publish_date date, n int")
    path = str(tmp_path / "days")
    lake.swap_partitions(days, path, ["publish_date"])
    assert lake.expire_days(spark, path, date(2024, 3, 31)) == []
    assert lake.expire_days(spark, path, date(2024, 4, 1)) == ["2024-01-01"]
    assert fs.child_dirs(spark, path) == ["publish_date=2024-03-31"]


def curated_row(spark, tmp_path, name, *pickups):
    rows = [
        trip(VendorID=i, tpep_pickup_datetime=p, tpep_dropoff_datetime=p.replace(minute=30))
        for i, p in enumerate(pickups)
    ]
    month = f"{pickups[0]:%Y-%m}-01"
    judged = batch.classify(typed(spark, rows, tmp_path / name, month), policy=None)
    return judged.select(*[n for n, _ in TRIPS.curated_schema()])


def test_incremental_fact(spark, tmp_path):
    path = str(tmp_path / "fact")
    may = curated_row(spark, tmp_path, "a", datetime(2021, 5, 5, 1), datetime(2021, 5, 31, 23))
    june = curated_row(spark, tmp_path, "b", datetime(2021, 6, 1, 1), datetime(2021, 6, 20, 1))
    both = may.unionByName(june).cache()
    star.build_fact(spark, both, path, month=Month.of("2021-06"))
    assert lake.read_table(spark, path).count() == 2  # a named month narrows the first build too
    star.build_fact(spark, both.filter("pickup_datetime < '2021-06-10'"), path, full_refresh=True)
    assert lake.read_table(spark, path).count() == 3
    star.build_fact(spark, both, path)  # from the start of the newest month, not its last trip
    assert lake.read_table(spark, path).count() == 4
    star.build_fact(spark, both, path, month=MAY)
    assert lake.read_table(spark, path).count() == 4
    with pytest.raises(lake.SchemaChanged):
        lake.guard_schema(spark, star.fact_trips(star.stage_trips(both)).withColumn("x", F.lit(1)), path)
