import random
from bisect import bisect_left, bisect_right
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from trips import START, refund, trip, typed

from monthlake.operators import checks, profile
from monthlake.plans import marts, reports, star
from monthlake.plans.batch import classify
from monthlake.plans.joins import dimension


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    rows = [
        trip(VendorID=1, PULocationID=132, DOLocationID=138),
        trip(VendorID=2, PULocationID=10, DOLocationID=138, passenger_count=None, payment_type=2),
        trip(VendorID=3, PULocationID=10, DOLocationID=20, trip_distance=0.0, tpep_dropoff_datetime=START, payment_type=2),
        trip(VendorID=4, PULocationID=264, DOLocationID=20, tpep_pickup_datetime=START + timedelta(days=1),
             tpep_dropoff_datetime=START + timedelta(days=1, hours=1), payment_type=2, tip_amount=0.0),
    ]
    judged = classify(typed(spark, rows, tmp_path_factory.mktemp("fact")), policy=None)
    return star.fact_trips(star.stage_trips(judged.filter("reject_reason is null"))).cache()


@pytest.fixture(scope="module")
def zones(spark):
    rows = [(i, "Queens" if i > 100 else "Bronx", f"Zone {i}", "Yellow") for i in (10, 20, 132, 138, 264)]
    return star.dim_zone(spark.createDataFrame(rows, star.ZONE_SCHEMA))


def test_daily_and_hourly(fact):
    daily = {str(r.pickup_date): r for r in marts.daily_metrics(fact).collect()}
    first = daily["2021-05-11"]
    assert (first.trips, first.flagged_trips, first.trips_with_recorded_passengers) == (3, 1, 2)
    assert first.avg_passengers_per_recorded_trip == 2.0
    assert first.card_tip_rate == pytest.approx(0.2)
    assert daily["2021-05-12"].card_tip_rate is None  # no card fares that day
    hourly = {(str(r.pickup_date), r.pickup_hour): r for r in marts.hourly_demand(fact).collect()}
    assert hourly["2021-05-11", 14].avg_speed_mph == pytest.approx(4.8 / (1800 / 3600))
    yearly = reports.yearly_summary(marts.daily_metrics(fact)).collect()
    assert [(r.year, r.trips) for r in yearly] == [(2021, 4)]
    assert checks.mart_reconciles(marts.daily_metrics(fact), fact).count() == 0
    assert checks.mart_reconciles(marts.daily_metrics(fact).limit(1), fact).count() == 1


def test_speed_is_null_without_seconds(fact):
    still = fact.filter("trip_duration_seconds = 0")
    assert marts.hourly_demand(still).collect()[0].avg_speed_mph is None


def test_airport_trip_counts_once(fact, zones):
    got = {(r.airport_code, r.direction): r.trips for r in marts.airport_trips(fact, zones).collect()}
    assert got == {("JFK", "pickup"): 1, ("LGA", "dropoff"): 1}
    names = {r.airport_name for r in reports.airport_monthly(marts.airport_trips(fact, zones)).collect()}
    assert names == {"JFK Airport", "LaGuardia Airport"}


def test_flows_and_boroughs(fact, zones):
    named = reports.zone_flows_named(marts.zone_flows(fact), zones)
    assert sorted(r.has_unknown_zone for r in named.collect()) == [False, False, False, True]
    flows = {(r.pickup_borough, r.dropoff_borough): r.trips for r in reports.borough_flows(named).collect()}
    assert flows == {("Queens", "Queens"): 1, ("Bronx", "Queens"): 1, ("Bronx", "Bronx"): 1}


def test_calendar(spark):
    days = {str(r.date_day): r for r in star.calendar(spark, "2019-12-29", "2020-01-02").collect()}
    assert len(days) == 5
    sunday = days["2019-12-29"]
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend, sunday.iso_week) == (1, "Sunday", True, 52)
    assert days["2020-01-02"].iso_week == 1 and str(days["2020-01-02"].month_start) == "2020-01-01"
    assert star.calendar(spark).count() == 2557


def test_dimension_checks_its_size(spark):
    small, large = spark.range(5), spark.range(50)
    assert "broadcast" in dimension(small, 10)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in dimension(large, 10)._jdf.queryExecution().logical().toString().lower()


def test_empty_fact_has_a_null_mark(fact):
    assert star.high_water_mark(fact.limit(0)).collect()[0].batch_high_water is None
    assert star.high_water_mark(fact).collect()[0].batch_high_water == START + timedelta(days=1)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (None, None)], "k int, v string")
    assert checks.not_null(df, "k").count() == 2
    assert [tuple(r) for r in checks.unique(df, "k").collect()] == [(1, 2)]  # NULLs are not equal
    assert [tuple(r) for r in checks.accepted_values(df, "v", ["a"]).collect()] == [("b", 2)]
    parent = spark.createDataFrame([("a",), (None,)], "p string")
    assert [tuple(r) for r in checks.relationships(df, "v", parent, "p").collect()] == [("b", 2)]


def test_twins_match_a_list_of_pairs(spark, tmp_path):
    rnd = random.Random(3)
    rows = []
    for _ in range(120):
        row = trip(
            VendorID=rnd.choice([1, 1, 2, None]), tip_amount=float(rnd.randint(0, 1)),
            congestion_surcharge=rnd.choice([2.75, None]), payment_type=rnd.randint(1, 2),
        )
        if rnd.random() < 0.5:
            row = {**row, **{m: -v if v else v for m, v in ((m, row[m]) for m in ("fare_amount", "extra", "mta_tax", "tip_amount", "improvement_surcharge", "total_amount", "congestion_surcharge"))}}
        rows.append(row)
    trips = typed(spark, rows, tmp_path).cache()
    listed = trips.collect()
    neg = [r for r in listed if r.fare_amount < 0 or r.total_amount < 0]
    pos = [r for r in listed if r.fare_amount >= 0 and r.total_amount >= 0]

    def minus(x):
        return None if x is None else -x

    for label, amounts in profile.TWIN_KEYS.items():
        twins = [
            (i, j)
            for i, n in enumerate(neg)
            for j, p in enumerate(pos)
            if all(n[k] is not None and n[k] == p[k] for k in profile.IDENTITY)
            and all(p[a] == minus(n[a]) for a in amounts)
        ]
        per_neg = [sum(i == k for i, _ in twins) for k in range(len(neg))]
        per_pos = [sum(j == k for _, j in twins) for k in range(len(pos))]
        got = profile.twin_summary(trips, label).collect()[0]
        assert got.matched_negatives == sum(n > 0 for n in per_neg)
        assert got.negatives_with_many_twins == sum(n > 1 for n in per_neg)
        assert got.positives_claimed_twice == sum(n > 1 for n in per_pos)
        if label == "fare":
            alone = {r.payment_type: r.unmatched for r in profile.unmatched_negatives(trips).collect()}
            want = {}
            for n, count in zip(neg, per_neg, strict=True):
                if not count:
                    want[n.payment_type] = want.get(n.payment_type, 0) + 1
            assert alone == want


def test_quantiles_within_rank_error(spark, tmp_path):
    rnd = random.Random(1)
    rows = [trip(trip_distance=round(rnd.random() * 20, 2), VendorID=i) for i in range(3000)]
    trips = typed(spark, rows, tmp_path).cache()
    values = sorted(r.trip_distance for r in trips.collect())
    for p, got in zip((0.999, 0.9999), profile.tail_quantiles(trips).collect()[0].dist_p999_p9999, strict=True):
        low, high = bisect_left(values, got) / len(values), bisect_right(values, got) / len(values)
        assert low - 0.001 <= p <= high + 0.001
    speeds = profile.speed_quantiles(trips).collect()[0].mph_p50_p99_p999
    exact = sorted(v * 4 for v in values)
    for p, got in zip((0.5, 0.99, 0.999), speeds, strict=True):
        near = bisect_left(exact, got - 1e-9) / len(exact), bisect_right(exact, got + 1e-9) / len(exact)
        assert near[0] - 0.001 <= p <= near[1] + 0.001


def test_medians_and_odd_negatives(spark, tmp_path):
    rows = [trip(VendorID=i, trip_distance=float(40 + i)) for i in range(5)]  # 160 mph and more
    rows += [trip(VendorID=9), refund(trip(VendorID=9), total_amount=0.0, payment_type=4)]
    trips = typed(spark, rows, tmp_path)
    got = profile.fast_medians(trips).collect()[0]
    assert (got.median_miles, got.median_secs) == (42.0, 900)
    odd = profile.inconsistent_negatives(trips).collect()
    assert [(r.payment_type, r.total_zero, r.total_positive) for r in odd] == [(4, 1, 0)]
    assert profile.inconsistent_sample(trips).count() == 1


def test_profile_counts(spark, tmp_path):
    rows = [trip(), trip(passenger_count=None, RatecodeID=None, store_and_fwd_flag=None),
            trip(fare_amount=1.005, PULocationID=0, tpep_pickup_datetime=datetime(2021, 6, 1), tpep_dropoff_datetime=datetime(2021, 6, 1))]
    got = profile.profile(typed(spark, rows, tmp_path)).collect()[0]
    assert (got.trips, got.passenger_count_unknown, got.meter_unknown) == (3, 1, 1)
    assert (got.after_month, got.zone_outside, got.minutes_at_0) == (1, 1, 1)
    assert got.source_month == date(2021, 5, 1)
    raw_money = typed(spark, rows, tmp_path).withColumn("fare_amount", F.lit(1.005))
    assert profile.profile(raw_money).collect()[0].amount_below_cents == 3
