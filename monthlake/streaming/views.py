"""Live views over the delivery table: exact at read time, and bounded-state variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monthlake.functions.columns import computed_once, whole_seconds
from monthlake.functions.contract import FLAGS, TRIPS
from monthlake.operators.rules import IDENTITY, first_failed, has_any_flag, row_flags, stream_rules
from monthlake.operators.skew import DEFAULT_POLICY, HotPolicy, group_total, hot_keys, key_hash, slot_of, split_hot
from monthlake.plans.joins import dimension
from monthlake.plans.star import FACT_COLUMNS
from monthlake.session import shared_folder

# Columns of the unified view, in order.
UNIFIED_COLUMNS = (
    "trip_id", "pickup_partition_ts", "pickup_datetime", "dropoff_datetime", "pickup_date",
    "pickup_hour", "trip_duration_seconds", "vendor_id", "ratecode_id", "payment_type",
    "pu_location_id", "do_location_id", "passenger_count", "trip_distance_miles", "fare_amount",
    "tip_amount", "total_amount", "has_quality_flag",
)


def first_deliveries(deliveries: DataFrame) -> DataFrame:
    """The first delivery of each event by (publish_time, message_id).

    A row number limited to the first: repeats of an event are dropped before the exchange, so one that was
    delivered a million times sends a row from each task; and rows are sorted by the event alone, not by all columns.
    """
    order = W.partitionBy("event_id").orderBy("publish_time", "message_id")
    return deliveries.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def typed_events(first: DataFrame) -> DataFrame:
    """Fills and derived columns; trip_distance keeps its name until the rules ran."""
    filled = {
        n: F.coalesce(F.col(n), F.lit(v).cast(dict(first.dtypes)[n]))
        for n, v in TRIPS.fills.items()
    }
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return first.withColumns(
        {
            **filled,
            "pickup_date": F.to_date(pickup),
            "pickup_hour": F.hour(pickup).cast("long"),
            "trip_duration_seconds": whole_seconds(pickup, dropoff),
        }
    )


def ruled_events(deliveries: DataFrame) -> DataFrame:
    """First deliveries, typed, with the first failed rule."""
    return computed_once(typed_events(first_deliveries(deliveries)), "reject_reason", first_failed(stream_rules()))


def several_trips(deliveries: DataFrame) -> DataFrame:
    """_event: hashes of the events that were delivered with more than one trip identity, written once.

    Only hashes are shuffled, one row for each event. Two events of one hash may be listed, which changes no result.
    """
    trip = key_hash(IDENTITY)
    per_event = deliveries.select(key_hash(["event_id"]).alias("_event"), trip.alias("_trip")).groupBy("_event")
    several = per_event.agg(F.min("_trip").alias("_a"), F.max("_trip").alias("_b")).filter("_a != _b").select("_event")
    path = shared_folder(deliveries.sparkSession, "several")
    several.write.parquet(path)
    return deliveries.sparkSession.read.parquet(path)


def _judged_by_trip(deliveries: DataFrame, twin: list) -> DataFrame:
    """Judged events with _twins by one exchange of whole rows, for events that come with one trip identity each.

    Fills, derived columns and reasons are found behind the exchange, so they are not shuffled.
    """
    rows = deliveries.repartition(*IDENTITY).withColumn("_key", key_hash(IDENTITY))
    order = W.partitionBy("_key", *IDENTITY, "event_id").orderBy("publish_time", "message_id")
    first = rows.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")
    events = computed_once(typed_events(first), "reject_reason", first_failed(stream_rules()))
    return events.withColumn("_twins", F.count(F.lit(1)).over(W.partitionBy("_key", *twin))).drop("_key")


def judged_events(deliveries: DataFrame, policy: HotPolicy | None = DEFAULT_POLICY) -> DataFrame:
    """First deliveries with the first failed rule and the soft flags.

    Rows are exchanged by trip, and both the first delivery of an event and its near duplicates are found there. Events
    delivered with several trips are brought together by event before that. Trips of more deliveries
    than the policy allows, which are found by counting a sample, are counted by slots, so that no identity fills a task.
    Without a policy nothing is looked for: rows are exchanged by event, then by trip.
    """
    kept = F.col("reject_reason").isNull()
    twin = [*IDENTITY, "fare_amount", kept]
    if policy is None:
        counted = ruled_events(deliveries).withColumn("_twins", F.count(F.lit(1)).over(W.partitionBy(*twin)))
        return _flagged(counted)
    several = several_trips(deliveries)
    rows = deliveries
    if not several.isEmpty():
        side, same = dimension(several), key_hash(["event_id"]) == F.col("_event")
        apart = first_deliveries(deliveries.join(side, same, "left_semi"))
        rows = deliveries.join(side, same, "left_anti").unionByName(apart)
    hot = hot_keys(deliveries, IDENTITY, policy)
    if hot.isEmpty():
        return _flagged(_judged_by_trip(rows, twin))
    ordinary, crowded = split_hot(rows, IDENTITY, hot)
    heavy = ruled_events(crowded)
    keyed = heavy.withColumns({"_twin": F.struct(*twin[:-1], kept.alias("kept")), "_slot": slot_of(F.md5("event_id"))})
    return _flagged(
        _judged_by_trip(ordinary, twin).unionByName(group_total(keyed, "_twin", "_slot", F.lit(1), "_twins").drop("_twin", "_slot"))
    )


def _flagged(counted: DataFrame) -> DataFrame:
    kept = F.col("reject_reason").isNull()
    flags = {**row_flags(), "is_near_duplicate": kept & F.coalesce(F.col("_twins") > 1, F.lit(False))}
    return (
        counted.withColumns(flags)
        .drop("_twins")
        .withColumnRenamed("trip_distance", "trip_distance_miles")
    )


def published_within(deliveries: DataFrame, as_of: Column, span: str, repeats: str = "1 day") -> DataFrame:
    """Deliveries that can decide on the events of the last `span` before `as_of`.

    Bound by the table's publish_date, so only the files of these days are opened. An event whose first delivery
    came more than `repeats` before the span counts as new when it is delivered again.
    """
    oldest = as_of - F.expr(f"interval {span}") - F.expr(f"interval {repeats}")
    return deliveries.filter(F.col("publish_date") >= F.to_date(oldest)).drop("publish_date")


LIVE_COLUMNS = (*[c for c in FACT_COLUMNS if c != "source_month"], "publish_time")


def fact_live(judged: DataFrame, columns: Sequence[str] = LIVE_COLUMNS) -> DataFrame:
    """Accepted events in the fact's shape; there is no source month, but a publish time.

    With fewer columns, `judged` needs only what these are made of.
    """
    derived = {
        "trip_id": F.col("event_id"),
        "pickup_partition_ts": F.col("pickup_datetime").cast("timestamp"),
        "has_quality_flag": has_any_flag(FLAGS),
    }
    accepted = judged.filter(F.col("reject_reason").isNull())
    return accepted.withColumns({n: c for n, c in derived.items() if n in columns}).select(*columns)


def fact_unified(fact: DataFrame, live: DataFrame, mark: DataFrame) -> DataFrame:
    """Batch history plus the stream's tail strictly after the one-row high-water mark.

    The mark is a scalar subquery: found once, then a plain filter on the stream side. A NULL mark
    (empty fact) serves no stream rows.
    """
    newest = mark.select("batch_high_water").scalar()
    tail = live.filter(F.col("pickup_datetime") > newest)
    return fact.select(*UNIFIED_COLUMNS, F.lit("batch").alias("served_from")).unionByName(
        tail.select(*UNIFIED_COLUMNS, F.lit("stream").alias("served_from"))
    )


# ---------------------------------------------------------------- low-latency variants


def dedup_within(deliveries: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Streaming dedup with bounded state.

    Exact for repeats that arrive within `delay` in publish time. Among repeats of one micro-batch
    any may win; use `first_deliveries` where that matters.
    """
    return deliveries.withWatermark("publish_time", delay).dropDuplicatesWithinWatermark(
        ["event_id"]
    )


def minute_counts(deliveries: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Streaming per-minute outcome counts by publish time (row rules only)."""
    typed = typed_events(deliveries.withWatermark("publish_time", delay))
    judged = computed_once(typed, "reject_reason", first_failed(stream_rules()))
    kept = F.col("reject_reason").isNull()
    return (
        judged.groupBy(F.window("publish_time", "1 minute"))
        .agg(
            F.count_if(kept).alias("trips"),
            F.count_if(~kept).alias("rejected"),
            F.sum(F.when(kept, F.col("total_amount")).otherwise(0)).alias("revenue"),
        )
        .select(F.col("window.start").alias("minute"), "trips", "rejected", "revenue")
    )
