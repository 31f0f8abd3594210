"""Findings of the fourth review: each test failed before its change."""

from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F
from test_live_state import ORDER, stream_of
from test_stream import deliveries
from trips import trip

from monthlake.catalogue import q_stream
from monthlake.plans import reports
from monthlake.sources import fs
from monthlake.streaming import ingest, state, views

SF = "/root/testdata/sf0.001"
DAY = state.DAY_MS


class Kept(list):
    """A list state, and the handle and the times of a processor; counts its calls."""

    calls, watermark, timers = 0, 0, frozenset()

    def getListState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return iter(list(self))

    def put(self, values):
        self.calls += 1
        self[:] = values

    def appendValue(self, value):
        self.calls += 1
        self.append(value)

    def registerTimer(self, at):
        self.calls += 1
        self.timers = self.timers | {at}

    def getCurrentWatermarkInMs(self):
        return self.watermark


def run(processor, batches, watermarks=None):
    """What a processor sends for batches of tuples, all of one bucket, batch by batch; and its state."""
    kept, sent = Kept(), []
    processor.init(kept)
    for n, batch in enumerate(batches):
        kept.watermark, before = watermarks[n] if watermarks else 0, kept.calls
        frames = [pd.DataFrame(batch[i : i + 400], columns=list(processor.takes)) for i in range(0, len(batch), 400)]
        sent.append([r for f in processor.handleInputRows((0,), iter(frames), kept) for r in f.itertuples(index=False, name=None)])
        assert kept.calls - before < 12  # however many keys came
    return sent, kept


def dealt(rows, batches, seed):
    rows = random.Random(seed).sample(rows, len(rows))
    return [rows[n::batches] for n in range(batches)]


def test_counts_of_many_events_take_few_calls():
    """state was called several times for each event."""
    rnd = random.Random(7)
    rows = []
    for n in range(3000):
        outcome, cents = rnd.choice(["kept", "negative_distance"]), rnd.choice(["-125", "990", None])
        rows += [(f"e{n}", rnd.randrange(10**10), f"m{n}-{i}", outcome, cents) for i in range(rnd.choice([1, 1, 3]))]
    sent, _ = run(state.OutcomeCounts(DAY), dealt(rows, 20, 1))
    events, amounts = Counter(), Counter()
    for at, outcome, n, amount in (r for batch in sent for r in batch):
        events[at, outcome] += n
        amounts[at, outcome] += 0 if pd.isna(amount) else amount
    firsts = {r[0]: r for r in sorted(rows, key=lambda r: r[1:3], reverse=True)}.values()
    minute = lambda r: r[1] - r[1] % 60_000_000
    want = Counter((minute(r), r[3]) for r in firsts) + Counter((minute(r), state.DELIVERY) for r in rows)
    assert {k: n for k, n in events.items() if n} == want
    for key in {(minute(r), r[3]) for r in firsts}:
        assert amounts[key] == sum(Decimal(r[4] or 0) / 100 for r in firsts if (minute(r), r[3]) == key)


def test_counts_keep_a_row_of_state_for_a_bucket(spark, tmp_path):
    """an event was a row of state, with a timer of its own."""
    rows = deliveries(spark, tmp_path / "in", [trip(tip_amount=float(i % 5)) for i in range(7)], ORDER, "s")
    stream = stream_of(spark, rows, tmp_path, [["m0", "m1", "m5"], ["m2", "m3"], ["m4", "m6"]])
    query = state.start_counts(state.outcome_changes(stream, "1 day", buckets=1), str(tmp_path / "t"), str(tmp_path / "c"))
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    as_of = F.lit("2024-06-14 18:30:00").cast("timestamp")
    want = reports.stream_quality(rows, views.judged_events(rows, None), as_of).collect()
    assert sorted(map(tuple, state.outcome_quality(spark, str(tmp_path / "t"), as_of).collect())) == sorted(map(tuple, want))


def test_flags_of_many_events_take_few_calls():
    """the last word on each event, whatever the batches; chunks are folded."""
    rnd = random.Random(3)
    rows = [(rnd.choice([state.REJECTED, *[f"t{i}" for i in range(900)]]), n, f"e{n}") for n in range(1500)]
    rows += rnd.sample(rows, 200)
    sent, kept = run(state.TwinFlag(DAY), dealt(rows, 3 * state.FOLD, 2))
    flags: dict = {}
    for event, flag in (r for batch in sent for r in batch):
        flags[event] = flags.get(event, False) or flag
    members = Counter(t for t, _, _ in set(rows))
    assert flags == {e: t != state.REJECTED and members[t] > 1 for t, _, e in rows}
    assert len(kept) <= state.FOLD


def test_first_deliveries_of_many_events_take_few_calls():
    """the least delivery is sent once a batch, and nothing that is not less."""
    rows = [(f"e{n % 1000}", (n * 7919) % 5000, f"m{n}", None) for n in range(4000)]
    sent, kept = run(state.FirstDelivery(DAY, ("flag",)), dealt(rows, 9, 5))
    last: dict = {}
    for batch in sent:
        assert len({r[0] for r in batch}) == len(batch)
        for event, at, flag in batch:
            assert at <= last.get(event, at) and flag is None
            last[event] = at
    want: dict = {}
    for event, at, *_ in rows:
        want[event] = min(at, want.get(event, at))
    assert last == want and len(kept.timers) == 1


def test_entries_go_when_their_time_is_over():
    """a repeat within the time is passed over, a later one is new; a timer takes old entries away."""
    hour, minute = 3_600_000_000, 60_000_000
    took = [("e", 0, "m0"), ("e", hour, "m1"), ("e", hour + minute, "m2"), ("e", hour + 2 * minute, "m3")]
    processor = state.FirstDelivery(hour // 1000, ())
    sent, kept = run(processor, [[r] for r in took], [0, hour // 1000, hour // 1000, hour // 1000])
    assert [[r[1] for r in batch] for batch in sent] == [[0], [], [hour + minute], []]
    other, kept = run(processor, [[("old", 0, "a")], [("new", hour, "b")]])
    kept.watermark = hour // 1000
    assert list(processor.handleExpiredTimer((0,), kept, None)) == []
    assert len(kept) == 1 and "new" in kept[0][0] and "old" not in kept[0][0]
    kept.watermark = min(kept.timers) - 1
    assert min(kept.timers) > hour // 1000 and max(kept.timers) > 2 * hour // 1000
    kept.clear = lambda: kept.put([])
    kept.watermark = max(kept.timers)
    processor.handleExpiredTimer((0,), kept, None)
    assert list(kept) == []


def test_whole_rows_pass_the_state_unchanged(spark, tmp_path):
    """all columns go through frames as text and come back with their types, nulls and microseconds."""
    trips = [trip(), trip(tip_amount=4.0, passenger_count=None, airport_fee=None), trip(fare_amount=12.34)]
    rows = deliveries(spark, tmp_path / "in", trips, ["18:00:05.000007", "18:00:01", "18:01:00"], "s")
    stream = stream_of(spark, rows, tmp_path, [["m0", "m2"], ["m1"]])
    updates = state.first_seen(stream, "1 day", buckets=1)
    assert updates.schema.simpleString() == rows.select(*updates.columns).schema.simpleString()
    query = state.start_updates(updates, str(tmp_path / "o"), str(tmp_path / "c"))
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in updates.schema)
    got = state.first_table(spark, str(tmp_path / "o"), schema)
    want = views.first_deliveries(rows.select(*updates.columns))
    assert got.count() == 3 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_batch_has_files_for_all_cores(spark, monkeypatch):
    """a batch was one file, so one task read and parsed it."""
    asked, real = [], ingest.json_source
    monkeypatch.setattr(ingest, "json_source", lambda spark, folder, files_per_batch: asked.append((folder, files_per_batch)) or real(spark, folder))
    q_stream._in_batches(spark, SF)
    folder, a_batch = asked[0]
    assert a_batch >= spark.sparkContext.defaultParallelism
    assert sum(n.startswith("part-") for n in fs.child_files(spark, folder)) >= 4 * spark.sparkContext.defaultParallelism
