"""Exact live views with bounded state: keyed processors with event-time timers.

The processors run in update mode and correct themselves: when an earlier delivery of an event comes
after a later one, or a trip's twin after the trip, the row in question is sent again. So the sinks are
tables of updates, one directory a batch, and a reader takes the last word on each event. The last word does not
depend on how deliveries were dealt to batches.

State is one small entry for each key; keys are dealt to buckets by hash, whose entries are kept together. An entry goes
`keep` after the time of the key's first delivery; a repeat later than that counts as new, and a delivery later than
`lateness` behind the newest one is left out here (it stays in the delivery table, whose views are exact at read time).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from monthlake.functions.columns import computed_once, row_fingerprint
from monthlake.operators.rules import IDENTITY, first_failed, row_flags, stream_rules
from monthlake.sources import fs
from monthlake.streaming.ingest import DELIVERED
from monthlake.streaming.views import first_deliveries, typed_events

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000
MINUTE = 60_000_000  # microseconds
#: Keys are dealt to so many buckets. A checkpoint keeps to the number it began with.
BUCKETS = 1024
#: Chunks of a bucket that are folded into one, and parts of `keep` by which entries are dropped together.
FOLD, SLOTS = 16, 24
DELIVERY = "delivery"  # the outcome under which every delivery counts
REJECTED = ""  # the trip of an event that failed a rule
COUNTS = "minute timestamp, outcome string, events bigint, amount decimal(25,2), publish_date date, batch_id int"


class Bucket(StatefulProcessor):
    """State of the keys of one bucket: entries [key, at, ...] as chunks of text, later ones over earlier ones.

    A call between Spark and a Python worker costs as much as hundreds of rows. So there are a few for each bucket and batch,
    however many keys come: the chunks are read, what changed is appended, and `FOLD` chunks are put together.
    An entry's time is over when the watermark has passed it by `keep`; what comes later than `keep` after it is new then. A
    timer takes such entries away, a part in `SLOTS` of `keep` later at most.
    """

    #: Columns that `changes` takes, event_id or another key first, and columns that it sends.
    takes: tuple[str, ...]
    sends: tuple[str, ...]

    def __init__(self, keep_ms: int):
        self.keep_ms, self.slot_ms = keep_ms, max(1, keep_ms // SLOTS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "entries string")

    def changes(self, rows: Iterator[tuple], known: Known) -> Iterable[tuple]:
        """What is sent for the rows of a batch; new entries are put into `known`."""
        raise NotImplementedError

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        chunks = self._read()
        known = Known(chunks, self.keep_ms, timerValues.getCurrentWatermarkInMs())
        slots = {self._slot(e) for e in known.entries.values()}
        taken = (row for frame in rows for row in zip(*(frame[c].tolist() for c in self.takes), strict=True))
        sent = list(self.changes(taken, known))
        if known.changed:
            if len(chunks) < FOLD:
                self.chunks.appendValue((json.dumps(list(known.changed.values())),))
            else:
                self.chunks.put([(json.dumps(list(known.entries.values())),)])
            for slot in {self._slot(e) for e in known.changed.values()} - slots:
                self.handle.registerTimer(slot)
        if sent:
            yield pd.DataFrame(sent, columns=list(self.sends))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        chunks, now = self._read(), timerValues.getCurrentWatermarkInMs()
        entries = Known(chunks, self.keep_ms, now).entries.values()
        left = [e for e in entries if e[1] // 1000 + self.keep_ms > now]
        if not left:
            self.chunks.clear()
        elif len(left) < len(entries):
            self.chunks.put([(json.dumps(left),)])
        return iter(())

    def _read(self) -> list:
        return [json.loads(text) for (text,) in self.chunks.get()]

    def _slot(self, entry: list) -> int:
        return ((entry[1] // 1000 + self.keep_ms) // self.slot_ms + 1) * self.slot_ms


class Known:
    """The entries of a bucket while a batch is handled."""

    def __init__(self, chunks: list, keep_ms: int, watermark_ms: int):
        self.keep, self.over = keep_ms * 1000, watermark_ms - keep_ms
        self.entries = {e[0]: e for chunk in chunks for e in chunk}
        self.changed: dict = {}

    def get(self, key: str, at: int) -> list | None:
        """The entry that a row of this time meets; None when there is none or its time is over."""
        e = self.entries.get(key)
        gone = e is not None and e[1] // 1000 <= self.over and at > e[1] + self.keep
        return None if gone else e

    def put(self, entry: list) -> None:
        self.entries[entry[0]] = self.changed[entry[0]] = entry


def _firsts(rows: Iterable[tuple]) -> Iterable[tuple]:
    """Of rows (event_id, at, message, ...) the least of each event."""
    firsts: dict = {}
    for r in rows:
        first = firsts.get(r[0])
        if first is None or r[1:3] < first[1:3]:
            firsts[r[0]] = r
    return firsts.values()


class FirstDelivery(Bucket):
    """Passes on the least delivery of an event by (publish time, message), and each one that is less."""

    def __init__(self, keep_ms: int, carried: tuple[str, ...]):
        super().__init__(keep_ms)
        self.takes, self.sends = ("event_id", "at", "message", *carried), ("event_id", "at", *carried)

    def changes(self, rows: Iterator[tuple], known: Known) -> Iterable[tuple]:
        for event, at, message, *carried in _firsts(rows):
            least = known.get(event, at)
            if least is None or (at, message) < (least[1], least[2]):
                known.put([event, at, message])
                yield event, at, *carried


class OutcomeCounts(Bucket):
    """What deliveries change in the counts by minute and outcome, summed for a bucket and batch.

    The first delivery of an event counts in its minute under its outcome; every delivery counts as one. When an earlier
    one comes, what the later one gave is taken back. So sums of changes are right at any time.
    """

    takes, sends = ("event_id", "at", "message", "outcome", "cents"), ("at", "outcome", "events", "amount")

    def changes(self, rows: Iterator[tuple], known: Known) -> Iterable[tuple]:
        sums: dict = {}

        def add(at: int, outcome: str, events: int, cents: str | None) -> None:
            total = sums.setdefault((at - at % MINUTE, outcome), [0, None])
            total[0] += events
            if cents is not None:
                total[1] = (total[1] or 0) + events * int(cents)

        def every() -> Iterator[tuple]:
            for r in rows:
                add(r[1], DELIVERY, 1, None)
                yield r

        for first in _firsts(every()):
            event, at, message, outcome, cents = first
            least = known.get(event, at)
            if least is not None:
                if (least[1], least[2]) <= (at, message):
                    continue
                add(least[1], least[3], -1, least[4])
            known.put(list(first))
            add(at, outcome, 1, cents)
        for (at, outcome), (events, cents) in sums.items():
            yield at, outcome, events, None if cents is None else Decimal(cents).scaleb(-2)


class TwinFlag(Bucket):
    """Flags events that share a trip's identity and fare with another accepted event.

    Of each trip the first event is kept, and whether a second one came. Only the first has to be
    corrected; all others are twins when they arrive. So a trip with millions of events costs one entry.
    """

    takes, sends = ("trip", "at", "event_id"), ("event_id", "is_near_duplicate")

    def changes(self, rows: Iterator[tuple], known: Known) -> Iterable[tuple]:
        flags: dict = {}
        for trip, at, event in rows:
            if trip == REJECTED:
                flags.setdefault(event, False)
                continue
            first = known.get(trip, at)
            if first is None:
                first = [trip, at, event, False]
                known.put(first)
            elif event != first[2] and not first[3]:
                first = [*first[:3], True]
                known.put(first)
                flags[first[2]] = True
            flags[event] = flags.get(event, False) or first[3]
        return flags.items()


def _timed(deliveries: DataFrame, lateness: str) -> DataFrame:
    """The delivery time in whole microseconds: no clock of a Python worker takes part."""
    return deliveries.withColumns(
        {"at": F.unix_micros("publish_time"), "message": F.coalesce("message_id", F.lit(""))}
    ).withWatermark("publish_time", lateness)


def _kept_by(rows: DataFrame, key: Column, buckets: int, processor: Bucket, schema: str) -> DataFrame:
    """The rows through keyed state; each key lies in one bucket. Frames hold texts and whole numbers alone, which pandas keeps exact."""
    return (
        rows.select("publish_time", *processor.takes, F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"))
        .groupBy("bucket")
        .transformWithStateInPandas(processor, schema, "Update", "EventTime")
    )


def first_seen(deliveries: DataFrame, lateness: str = "1 hour", keep_days: float = 1.0, buckets: int = BUCKETS) -> DataFrame:
    """A stream of deliveries as updates: the least delivery of each event known so far, with the columns given."""
    given = deliveries.select(*[c for c in DELIVERED if c in deliveries.columns])
    carried = {f.name: f.dataType for f in given.schema if f.name not in ("event_id", "publish_time")}
    rows = _timed(given, lateness).withColumns({c: F.col(c).cast("string") for c in carried})
    processor = FirstDelivery(int(keep_days * DAY_MS), tuple(carried))
    schema = ", ".join(["event_id string, at bigint", *[f"{c} string" for c in carried]])
    kept = _kept_by(rows, F.col("event_id"), buckets, processor, schema)
    back = {"publish_time": F.timestamp_micros("at"), **{c: F.col(c).cast(kind) for c, kind in carried.items()}}
    return kept.withColumns(back).select(*given.columns)


def _judged(deliveries: DataFrame, lateness: str) -> DataFrame:
    return computed_once(typed_events(_timed(deliveries, lateness)), "reject_reason", first_failed(stream_rules()))


def twin_flags(deliveries: DataFrame, lateness: str = "1 hour", keep_days: float = 1.0, buckets: int = BUCKETS) -> DataFrame:
    """A stream of deliveries as updates event_id, is_near_duplicate.

    Repeats of one event are no twins of each other. Rejected events are never flagged.
    """
    trip = F.when(F.col("reject_reason").isNull(), row_fingerprint([*IDENTITY, "fare_amount"])).otherwise(REJECTED)
    rows = _judged(deliveries, lateness).select("publish_time", "event_id", "at", trip.alias("trip"))
    key = F.when(F.col("trip") == REJECTED, F.col("event_id")).otherwise(F.col("trip"))
    schema = "event_id string, is_near_duplicate boolean"
    return _kept_by(rows, key, buckets, TwinFlag(int(keep_days * DAY_MS)), schema)


def outcome_changes(deliveries: DataFrame, lateness: str = "1 hour", keep_days: float = 1.0, buckets: int = BUCKETS) -> DataFrame:
    """A stream of deliveries as changes at (microseconds, whole minutes), outcome (kept or the first failed rule), events, amount."""
    outcome = F.coalesce("reject_reason", F.lit("kept")).alias("outcome")
    cents = (F.col("total_amount").cast("decimal(15,2)") * 100).cast("bigint").cast("string").alias("cents")
    rows = _judged(deliveries, lateness).select("publish_time", "event_id", "at", "message", outcome, cents)
    schema = "at bigint, outcome string, events bigint, amount decimal(25,2)"
    return _kept_by(rows, F.col("event_id"), buckets, OutcomeCounts(int(keep_days * DAY_MS)), schema)


def start_counts(changes: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep table/publish_date=d/batch_id=n: changes summed by minute and outcome, some rows a batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        minute = F.date_trunc("minute", F.timestamp_micros("at"))
        summed = batch.groupBy(minute.alias("minute"), "outcome").agg(
            F.sum("events").alias("events"), F.sum("amount").cast("decimal(25,2)").alias("amount")
        )
        (
            summed.filter((F.col("events") != 0) | (F.col("amount") != 0))
            .withColumns({"publish_date": F.to_date("minute"), "batch_id": F.lit(batch_id)})
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("publish_date", "batch_id")
            .parquet(table)
        )

    return _start(changes, write, checkpoint, trigger)


def minute_table(spark: SparkSession, table: str, since: Column) -> DataFrame:
    """minute, outcome, events, amount from `since` on; only the files of these days are opened."""
    rows = spark.read.schema(COUNTS).parquet(table) if fs.child_dirs(spark, table) else spark.createDataFrame([], COUNTS)
    recent = rows.filter((F.col("publish_date") >= F.to_date(since)) & (F.col("minute") >= since))
    return recent.groupBy("minute", "outcome").agg(F.sum("events").alias("events"), F.sum("amount").alias("amount"))


def last_hour(spark: SparkSession, table: str, as_of: Column, minutes: int = 60) -> DataFrame:
    """Accepted and rejected events by minute; whole minutes, so `as_of` is taken down to one."""
    rows = minute_table(spark, table, F.date_trunc("minute", as_of) - F.expr(f"interval {minutes} minutes"))
    kept = F.col("outcome") == "kept"
    counted = rows.filter(F.col("outcome") != DELIVERY).groupBy("minute")
    return counted.agg(
        F.coalesce(F.sum(F.when(kept, F.col("events"))), F.lit(0)).alias("trips"),
        F.coalesce(F.sum(F.when(~kept, F.col("events"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.when(kept, F.col("amount"))), F.lit(0)).alias("revenue"),
    ).filter("trips != 0 or rejected != 0")


def outcome_quality(spark: SparkSession, table: str, as_of: Column, hours: int = 24) -> DataFrame:
    """Every delivery of the last hours by outcome; what events do not account for are duplicate deliveries."""
    rows = minute_table(spark, table, F.date_trunc("minute", as_of) - F.expr(f"interval {hours} hours"))
    totals = rows.groupBy("outcome").agg(F.sum("events").alias("events"))
    every = F.col("outcome") == DELIVERY
    repeats = totals.agg(
        F.lit("duplicate_delivery").alias("outcome"),
        F.coalesce(F.sum(F.when(every, F.col("events")).otherwise(-F.col("events"))), F.lit(0)).alias("events"),
    )
    return totals.filter(~every & (F.col("events") != 0)).unionByName(repeats)


def start_updates(updates: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write a stream of updates as table/batch_id=n; a batch that runs again replaces its own rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{table}/batch_id={batch_id}")

    return _start(updates, write, checkpoint, trigger)


def _start(updates: DataFrame, write, checkpoint: str, trigger: dict) -> StreamingQuery:
    """A query takes its settings when it starts; the session keeps its own."""
    spark, key = updates.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)
    try:
        return (
            updates.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        spark.conf.set(key, before)


def _updates(spark: SparkSession, table: str, schema: str) -> DataFrame:
    if not fs.child_dirs(spark, table):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(table).drop("batch_id")


def first_table(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """The last word on each event: of all updates the least delivery."""
    return first_deliveries(_updates(spark, table, schema))


def flag_table(spark: SparkSession, table: str) -> DataFrame:
    """event_id with its flag; once true, a flag stays true."""
    rows = _updates(spark, table, "event_id string, is_near_duplicate boolean")
    return rows.groupBy("event_id").agg(F.bool_or("is_near_duplicate").alias("is_near_duplicate"))


def live_flags(deliveries: DataFrame, flags: DataFrame) -> DataFrame:
    """First deliveries with all soft flags; that of near duplicates is read from `flags`, not counted."""
    typed = typed_events(first_deliveries(deliveries))
    return (
        typed.withColumns(row_flags())
        .join(flags, "event_id", "left")
        .withColumn("is_near_duplicate", F.coalesce("is_near_duplicate", F.lit(False)))
    )
