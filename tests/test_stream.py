import json
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F
from trips import trip, typed

from monthlake.functions.columns import row_fingerprint
from monthlake.functions.contract import TRIPS
from monthlake.plans import reports
from monthlake.streaming import ingest, views
from monthlake.streaming.wire import decode, wire_event


def wire(spark, tmp_path, rows, name="w"):
    trips = typed(spark, rows, tmp_path / name).withColumn("event_id", row_fingerprint(TRIPS.names))
    when = F.lit("2024-06-14 18:00:00").cast("timestamp")
    data = wire_event(trips, event_id=F.col("event_id"), event_ts=when)
    return trips.select(F.col("event_id").alias("message_id"), when.alias("publish_time"), data.alias("data"))


def test_wire_form(spark, tmp_path):
    row = wire(spark, tmp_path, [trip(passenger_count=None, extra=1.1 + 2.2)]).collect()[0]
    event = json.loads(row.data)
    assert event["pickup_datetime"] == "2021-05-11 14:30:00"
    assert event["passenger_count"] is None
    assert event["ratecode_id"] == {"long": 1}
    assert event["store_and_fwd_flag"] == {"string": "N"}
    assert event["extra"] == "3.30"
    assert event["congestion_surcharge"] == {"string": "2.75"}
    assert event["cbd_congestion_fee"] is None
    assert event["event_ts"] == 1718388000000000
    assert list(event)[:3] == ["event_id", "event_ts", "vendor_id"]


def test_round_trip_and_contract(spark, tmp_path):
    good = wire(spark, tmp_path, [trip()])
    text = good.collect()[0].data
    event = json.loads(text)
    broken = {
        "missing": {k: v for k, v in event.items() if k != "fare_amount"},
        "bare": {**event, "passenger_count": 1},
        "branch": {**event, "passenger_count": {"int": 1}},
        "money": {**event, "fare_amount": "ten"},
        "clock": {**event, "pickup_datetime": "yesterday"},
        "null": {**event, "vendor_id": None},
    }
    rows = [("good", text), ("junk", "no json"), ("empty", None)]
    rows += [(k, json.dumps(v)) for k, v in broken.items()]
    frame = spark.createDataFrame(rows, "message_id string, data string").withColumn(
        "publish_time", F.lit("2024-06-14").cast("timestamp")
    )
    got = {r.message_id: r for r in decode(frame).collect()}
    assert got["good"].contract_error is None
    assert got["good"].fare_amount == Decimal("12.50")
    assert got["good"].pickup_datetime == datetime(2021, 5, 11, 14, 30)
    assert got["missing"].contract_error == "missing: fare_amount"
    assert got["null"].contract_error == "missing: vendor_id"
    assert got["money"].contract_error == "unreadable: fare_amount"
    assert got["clock"].contract_error == "unreadable: pickup_datetime"
    assert got["branch"].contract_error == "unreadable: passenger_count"
    assert all(got[k].contract_error == "not an event" for k in ("junk", "empty", "bare"))


def test_ingest_keeps_every_delivery_once(spark, tmp_path):
    inbox, table, state = (str(tmp_path / p) for p in ("inbox", "table", "state"))
    first = wire(spark, tmp_path, [trip(), trip(PULocationID=2)], "a")
    first.write.json(inbox)

    def go():
        ingest.start_ingest(ingest.json_source(spark, inbox), table, state).awaitTermination()

    go()
    go()  # nothing new: nothing added
    assert ingest.delivered(spark, table).count() == 2
    junk = first.limit(1).withColumn("data", F.lit("junk"))
    first.unionByName(junk).write.mode("append").json(inbox)
    go()
    assert ingest.delivered(spark, table).count() == 4  # repeats stay
    bad = ingest.refused(spark, table).collect()
    assert [(r.data, r.contract_error) for r in bad] == [("junk", "not an event")]


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    """A batch that failed before its commit runs again and replaces its own rows only."""
    inbox, table, state = (str(tmp_path / p) for p in ("inbox", "table", "s1"))
    wire(spark, tmp_path, [trip()], "a").write.json(inbox)

    def go(checkpoint):
        ingest.start_ingest(ingest.json_source(spark, inbox), table, checkpoint).awaitTermination()

    go(state)
    for mark in (tmp_path / "s1" / "commits").iterdir():  # the commit is lost: batch 0 runs again
        mark.unlink()
    go(state)
    assert ingest.delivered(spark, table).count() == 1
    go(str(tmp_path / "s2"))  # another stream on the same table: its rows are added
    assert ingest.delivered(spark, table).count() == 2


def test_only_refused(spark, tmp_path):
    inbox, table = str(tmp_path / "inbox"), str(tmp_path / "table")
    wire(spark, tmp_path, [trip()]).withColumn("data", F.lit("junk")).write.json(inbox)
    ingest.start_ingest(ingest.json_source(spark, inbox), table, str(tmp_path / "s")).awaitTermination()
    assert ingest.delivered(spark, table).count() == 0
    assert ingest.refused(spark, table).count() == 1


def deliveries(spark, tmp_path, rows, times, name="d"):
    out = None
    for i, (row, t) in enumerate(zip(rows, times, strict=True)):
        one = decode(wire(spark, tmp_path, [row], f"{name}{i}")).withColumns(
            {
                "publish_time": F.lit(f"2024-06-14 {t}").cast("timestamp"),
                "message_id": F.lit(f"m{i}"),
            }
        )
        out = one if out is None else out.unionByName(one)
    return out.select(*ingest.DELIVERED).cache()


def test_live_views(spark, tmp_path):
    rows = [
        trip(), trip(), trip(tip_amount=4.0), trip(PULocationID=0), trip(VendorID=9, fare_amount=-1.0),
    ]
    got = deliveries(spark, tmp_path, rows, ["18:00:05", "18:00:01", "18:01:00", "18:01:30", "16:00:00"])
    first = views.first_deliveries(got)
    assert sorted(r.message_id for r in first.collect()) == ["m1", "m2", "m3", "m4"]
    judged = views.judged_events(got).cache()
    reasons = {r.message_id: (r.reject_reason, r.is_near_duplicate) for r in judged.collect()}
    assert reasons == {
        "m1": (None, True),
        "m2": (None, True),
        "m3": ("invalid_location_id", False),
        "m4": ("negative_amount_unmatched", False),
    }
    as_of = F.lit("2024-06-14 18:30:00").cast("timestamp")
    minutes = {r.minute.strftime("%H:%M"): (r.trips, r.rejected) for r in reports.live_last_hour(judged, as_of).collect()}
    assert minutes == {"18:00": (1, 0), "18:01": (1, 1)}
    quality = {r.outcome: r.events for r in reports.stream_quality(got, judged, as_of).collect()}
    assert quality == {
        "kept": 2, "invalid_location_id": 1, "negative_amount_unmatched": 1, "duplicate_delivery": 1,
    }


def test_unified_serves_strictly_after_the_mark(spark, tmp_path):
    rows = [trip(), trip(PULocationID=3, tpep_pickup_datetime=datetime(2021, 5, 11, 14, 30, 1))]
    live = views.fact_live(views.judged_events(deliveries(spark, tmp_path, rows, ["18:00:00", "18:00:01"])))
    fact = live.filter("pu_location_id = 75")

    def served(mark):
        frame = spark.createDataFrame([(mark,)], "batch_high_water timestamp_ntz")
        return sorted((r.pu_location_id, r.served_from) for r in views.fact_unified(fact, live, frame).collect())

    assert served(datetime(2021, 5, 11, 14, 30)) == [(3, "stream"), (75, "batch")]
    assert served(None) == [(75, "batch")]


def test_bounded_state_variants(spark, tmp_path):
    source, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows = [trip(), trip(), trip(PULocationID=0)]
    frame = deliveries(spark, tmp_path, rows, ["18:00:05", "18:00:01", "18:01:00"])
    frame.write.parquet(source)
    stream = spark.readStream.schema(frame.schema).parquet(source)
    views.dedup_within(stream).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "c1")
    ).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 2
    query = (
        views.minute_counts(stream).writeStream.outputMode("complete").format("memory")
        .queryName("minutes").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "c2")).start()
    )
    query.awaitTermination()
    got = {r.minute.strftime("%H:%M"): (r.trips, r.rejected) for r in spark.table("minutes").collect()}
    assert got == {"18:00": (2, 0), "18:01": (0, 1)}
