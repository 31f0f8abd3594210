"""Keyed stream state and compaction against the exact views."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from test_stream import deliveries, wire
from trips import trip

from monthlake.plans import reports
from monthlake.streaming import compaction, ingest, state, views

ORDER = ["18:00:05", "18:00:01", "18:01:00", "18:01:30", "16:00:00", "18:00:03", "17:59:59"]


@pytest.fixture(scope="module")
def seven(spark, tmp_path_factory):
    rows = [
        trip(), trip(), trip(tip_amount=4.0), trip(PULocationID=0), trip(VendorID=9, fare_amount=-1.0), trip(), trip(tip_amount=5.0),
    ]
    return deliveries(spark, tmp_path_factory.mktemp("seven"), rows, ORDER, "s")


def stream_of(spark, frame, folder, batches):
    """A stream that reads the rows of each batch (lists of message ids) as one file, in this order."""
    for n, ids in enumerate(batches):
        frame.filter(F.col("message_id").isin(ids)).coalesce(1).write.mode("append").parquet(str(folder / "src"))
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "src"))


def run_flags(spark, stream, folder, **kept):
    state.start_updates(state.twin_flags(stream, **kept), str(folder / "f"), str(folder / "cf")).awaitTermination()
    return {r.event_id: r.is_near_duplicate for r in state.flag_table(spark, str(folder / "f")).collect()}


def run_first(spark, stream, frame, folder, **kept):
    state.start_updates(state.first_seen(stream, **kept), str(folder / "o"), str(folder / "co")).awaitTermination()
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)
    return sorted(r.message_id for r in state.first_table(spark, str(folder / "o"), schema).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_last_words_do_not_depend_on_batches(spark, seven, tmp_path, seed):
    names = [f"m{i}" for i in range(7)]
    random.Random(seed).shuffle(names)
    cut = sorted(random.Random(seed + 5).sample(range(1, 7), 2 if seed == 1 else 4))
    batches = [names[a:b] for a, b in zip([0, *cut], [*cut, 7], strict=True)]
    stream = stream_of(spark, seven, tmp_path, batches)
    first = run_first(spark, stream, seven, tmp_path, lateness="1 day")
    assert first == sorted(r.message_id for r in views.first_deliveries(seven).collect())
    got = run_flags(spark, stream, tmp_path, lateness="1 day")
    want = {r.event_id: r.is_near_duplicate for r in views.judged_events(seven).collect()}
    assert got == want and sorted(want.values()) == [False, False, True, True, True]
    live = state.live_flags(seven, state.flag_table(spark, str(tmp_path / "f")))
    assert {r.event_id: r.is_near_duplicate for r in live.collect()} == want


@pytest.mark.parametrize("seed", [3, 4])
def test_kept_counts_equal_the_reports(spark, seven, tmp_path, seed):
    """Minutes and outcomes summed from changes, whatever the batches, and only the days asked for are opened."""
    names = [f"m{i}" for i in range(7)]
    random.Random(seed).shuffle(names)
    stream = stream_of(spark, seven, tmp_path, [names[:2], names[2:3], names[3:6], names[6:]])
    table = str(tmp_path / "counts")
    changes = state.outcome_changes(stream, lateness="1 day")
    state.start_counts(changes, table, str(tmp_path / "cc")).awaitTermination()
    as_of = F.lit("2024-06-14 18:30:00").cast("timestamp")
    events = views.judged_events(seven, None)
    want = sorted(map(tuple, reports.live_last_hour(events, as_of).collect()))
    assert sorted(map(tuple, state.last_hour(spark, table, as_of).collect())) == want and len(want) == 3
    want = sorted(map(tuple, reports.stream_quality(seven, events, as_of).collect()))
    assert sorted(map(tuple, state.outcome_quality(spark, table, as_of).collect())) == want
    for back in range(1, 30):
        day = date(2024, 6, 14) - timedelta(days=back)
        old = spark.read.parquet(table).withColumn("publish_date", F.lit(day)).withColumn("minute", F.col("minute") - F.expr(f"interval {back} days"))
        old.coalesce(1).write.mode("append").partitionBy("publish_date", "batch_id").parquet(str(tmp_path / "more"))
    rows = state.minute_table(spark, str(tmp_path / "more"), as_of - F.expr("interval 25 hours"))
    assert {str(r.minute)[:10] for r in rows.collect()} == {"2024-06-13"}
    assert "PartitionFilters: [isnotnull(publish_date" in rows._jdf.queryExecution().toString()


def test_no_counts_yet(spark, tmp_path):
    as_of = F.lit("2024-06-14 18:30:00").cast("timestamp")
    assert state.last_hour(spark, str(tmp_path / "none"), as_of).collect() == []
    assert [tuple(r) for r in state.outcome_quality(spark, str(tmp_path / "none"), as_of).collect()] == [("duplicate_delivery", 0)]


def test_the_earliest_of_one_batch_wins(spark, seven, tmp_path):
    stream = stream_of(spark, seven, tmp_path, [["m0", "m1", "m5"]])
    assert run_first(spark, stream, seven, tmp_path, lateness="1 day") == ["m1"]
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1


def test_state_is_dropped_after_its_time(spark, seven, tmp_path):
    """A repeat after the state went counts as new; within it, it is passed over."""
    later = seven.filter("message_id = 'm1'").withColumn("message_id", F.lit("again"))
    other = seven.filter("message_id = 'm2'")
    at = lambda df, t: df.withColumn("publish_time", F.lit(t).cast("timestamp"))
    rows = [
        at(seven.filter("message_id = 'm1'"), "2024-06-14 18:00:00"),
        at(other, "2024-06-14 18:30:00"),
        at(later, "2024-06-14 18:31:00"),  # within the hour
        at(other.withColumn("event_id", F.lit("x")), "2024-06-14 20:30:00"),
        at(other.withColumn("event_id", F.lit("y")), "2024-06-14 20:31:00"),
        at(later, "2024-06-14 20:32:00"),
    ]
    for df in rows:
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
    stream = spark.readStream.schema(seven.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "src"))
    state.start_updates(
        state.first_seen(stream, "10 minutes", keep_days=1 / 24), str(tmp_path / "o"), str(tmp_path / "c")
    ).awaitTermination()
    sent = [(r.message_id, r.publish_time.strftime("%H:%M")) for r in spark.read.parquet(str(tmp_path / "o")).collect()]
    assert ("again", "18:31") not in sent and ("again", "20:32") in sent and len(sent) == 5


def test_session_keeps_its_state_store(spark, seven, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    run_first(spark, stream_of(spark, seven, tmp_path, [["m0"]]), seven, tmp_path)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    assert state.flag_table(spark, str(tmp_path / "none")).collect() == []


# ---------------------------------------------------------------- compaction


@pytest.fixture()
def table(spark, tmp_path):
    """Three batches over two days, with a refused delivery in each."""
    inbox, path, checkpoint = (str(tmp_path / p) for p in ("inbox", "table", "state"))
    for n in range(3):
        rows = wire(spark, tmp_path, [trip(), trip(PULocationID=2 + n), trip(PULocationID=9)], f"b{n}")
        day = F.when(F.col("message_id") == rows.agg(F.min("message_id")).head()[0], "2024-06-13").otherwise("2024-06-14")
        rows = rows.withColumn("publish_time", F.concat(day, F.lit(f" 18:0{n}:00")).cast("timestamp"))
        junk = rows.limit(1).withColumn("data", F.lit("junk")).withColumn("publish_time", F.lit("2024-06-14 10:00:00").cast("timestamp"))
        rows.unionByName(junk).coalesce(1).write.mode("append").json(inbox)
        ingest.start_ingest(ingest.json_source(spark, inbox), path, checkpoint).awaitTermination()
    return path, checkpoint


def everything(spark, path):
    good = [(r.message_id, r.publish_time, r.event_id) for r in ingest.delivered(spark, path).collect()]
    return sorted(good), sorted((r.publish_time, r.data) for r in ingest.refused(spark, path).collect())


DAY = date(2024, 6, 14)


def folds(spark, path, outcome):
    base = f"{path}/outcome={outcome}"
    return sum("folded" in n for d in compaction.fs.child_dirs(spark, base) for n in compaction.fs.child_dirs(spark, f"{base}/{d}"))


def files(spark, path):
    found = compaction.data_files(ingest.delivered(spark, path)).collect()
    return {r.publish_date: r.files for r in found}


def test_compaction_keeps_every_row(spark, table):
    path, checkpoint = table
    before, count = everything(spark, path), files(spark, path)
    assert len(before[0]) == 9 and len(before[1]) == 3 and count[DAY] > 1
    assert compaction.days(spark, path) == [date(2024, 6, 13), DAY]
    assert compaction.compact(spark, path, DAY, checkpoint).startswith("folded-")
    assert everything(spark, path) == before and files(spark, path)[DAY] == 1
    assert compaction.compact(spark, path, DAY, checkpoint) is None  # one directory is left
    assert everything(spark, path) == before


def test_later_rows_of_a_folded_day(spark, table, tmp_path):
    path, checkpoint = table
    compaction.compact(spark, path, DAY, checkpoint)
    more = wire(spark, tmp_path, [trip(PULocationID=50)], "late").withColumn("publish_time", F.lit("2024-06-14 23:00:00").cast("timestamp"))
    more.write.mode("append").json(str(tmp_path / "inbox"))
    ingest.start_ingest(ingest.json_source(spark, str(tmp_path / "inbox")), path, checkpoint).awaitTermination()
    rows = everything(spark, path)
    assert len(rows[0]) == 10 and files(spark, path)[DAY] == 2
    assert compaction.compact(spark, path, DAY, checkpoint) is not None
    assert everything(spark, path) == rows and files(spark, path)[DAY] == 1
    # The first fold goes on for the refused rows alone, which had nothing to fold.
    assert folds(spark, path, "delivered") == 1 and folds(spark, path, "refused") == 1


@pytest.mark.parametrize("step", ["write", "marker", "delete", "done"])
def test_a_run_that_dies_loses_and_doubles_nothing(spark, table, monkeypatch, step):
    path, checkpoint = table
    before = everything(spark, path)
    fs = compaction.fs
    real = {"delete": fs.delete, "write_text": fs.write_text}
    calls = {"delete": 0}

    def die(*_):
        raise RuntimeError("killed")

    def some_deletes(spark_, p):
        calls["delete"] += 1
        return real["delete"](spark_, p) if calls["delete"] < 3 else die()

    def marker_then(spark_, p, text):
        if p.endswith(".done"):
            die()
        return real["write_text"](spark_, p, text)

    if step == "write":
        monkeypatch.setattr(fs, "write_text", die)
    elif step == "marker":
        monkeypatch.setattr(fs, "delete", die)
    elif step == "delete":
        monkeypatch.setattr(fs, "delete", some_deletes)
    else:
        monkeypatch.setattr(fs, "write_text", marker_then)
    with pytest.raises(RuntimeError, match="killed"):
        compaction.compact(spark, path, DAY, checkpoint)
    assert everything(spark, path) == before  # readers see each row once, whatever was left behind
    monkeypatch.undo()
    compaction.compact(spark, path, DAY, checkpoint)
    assert everything(spark, path) == before and files(spark, path)[DAY] == 1
    assert folds(spark, path, "delivered") == 1


def test_an_uncommitted_batch_is_not_folded(spark, table, tmp_path):
    """It may be written again; folded, its rows would then come twice."""
    path, checkpoint = table
    before = everything(spark, path)
    (tmp_path / "state" / "commits" / "2").unlink()
    for crc in (tmp_path / "state" / "commits").glob(".2.crc"):
        crc.unlink()
    compaction.compact(spark, path, DAY, checkpoint)
    assert everything(spark, path) == before
    ingest.start_ingest(ingest.json_source(spark, str(tmp_path / "inbox")), path, checkpoint).awaitTermination()
    assert everything(spark, path) == before


def test_retention_on_the_ingest_table(spark, table):
    path, checkpoint = table
    compaction.compact(spark, path, DAY, checkpoint)
    compaction.compact(spark, path, DAY - timedelta(days=1), checkpoint)
    assert compaction.expire(spark, path, DAY, keep_days=0) == ["2024-06-13"]
    assert compaction.days(spark, path) == [DAY] and len(compaction.markers(spark, path)) == 1
    assert compaction.expire(spark, path, DAY + timedelta(days=9), keep_days=1) == ["2024-06-14"]
    assert everything(spark, path) == ([], [])
