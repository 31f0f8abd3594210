"""The event on the wire: JSON with named union branches, exact money text, wall-clock text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.functions.columns import computed_once

# Event fields in order, wire type, required or nullable. A nullable value is wrapped
# in an object that names its branch; a required one is plain.
FIELDS = [
    ("event_id", "string", "required"),
    ("event_ts", "long", "required"),
    ("vendor_id", "long", "required"),
    ("pickup_datetime", "string", "required"),
    ("dropoff_datetime", "string", "required"),
    ("passenger_count", "long", "nullable"),
    ("trip_distance", "double", "required"),
    ("ratecode_id", "long", "nullable"),
    ("store_and_fwd_flag", "string", "nullable"),
    ("pu_location_id", "long", "required"),
    ("do_location_id", "long", "required"),
    ("payment_type", "long", "required"),
    ("fare_amount", "string", "required"),
    ("extra", "string", "required"),
    ("mta_tax", "string", "required"),
    ("tip_amount", "string", "required"),
    ("tolls_amount", "string", "required"),
    ("improvement_surcharge", "string", "required"),
    ("total_amount", "string", "required"),
    ("congestion_surcharge", "string", "nullable"),
    ("airport_fee", "string", "nullable"),
    ("cbd_congestion_fee", "string", "nullable"),
]
REQUIRED_FIELDS = [n for n, _, need in FIELDS if need == "required"]
MONEY_FIELDS = [n for n, _, _ in FIELDS if n.endswith(("_amount", "_fee", "_surcharge", "_tax")) or n == "extra"]
WALL_CLOCK_FIELDS = ("pickup_datetime", "dropoff_datetime")
WALL_CLOCK = "yyyy-MM-dd HH:mm:ss"
SPARK_TYPE = {"long": "bigint", "string": "string", "double": "double"}
#: What the broker adds to an event. The last two are carried along and never judged.
ENVELOPE = "message_id string, publish_time timestamp, data string, subscription_name string, attributes string"
CARRIED = ("subscription_name", "attributes")


def wire_schema() -> str:
    parts = []
    for name, kind, need in FIELDS:
        spark_type = SPARK_TYPE[kind]
        parts.append(
            f"{name} {spark_type}" if need == "required" else f"{name} struct<{kind}: {spark_type}>"
        )
    return ", ".join([*parts, "_broken string"])


def wire_event(trip: DataFrame, *, event_id: Column, event_ts: Column) -> Column:
    """A canonical trip as wire JSON (NULL for an absent nullable value)."""
    fields = []
    for name, kind, need in FIELDS:
        value = F.col(name) if name in trip.columns else F.lit(None)
        if name == "event_id":
            value = event_id
        elif name == "event_ts":
            value = F.unix_micros(event_ts)
        elif name in WALL_CLOCK_FIELDS:
            value = F.date_format(value, WALL_CLOCK)
        elif name in MONEY_FIELDS:
            value = value.cast("decimal(15,2)").cast("string")
        else:
            value = value.cast(SPARK_TYPE[kind])
        if need == "nullable":
            value = F.when(value.isNotNull(), F.struct(value.alias(kind)))
        fields.append(value.alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _wall_clock(text: Column) -> Column:
    """Date and time to the second. The cast is several times faster than a parse by pattern."""
    return F.when(F.length(text) == len(WALL_CLOCK), text.try_cast("timestamp_ntz"))


def decode(deliveries: DataFrame) -> DataFrame:
    """Parse `data` and judge it against the contract.

    Adds typed columns and `contract_error`: NULL for a valid event, else what is wrong. Works on
    batch and streaming frames. `_broken` holds text that is no JSON or has a value of another type
    than the field's.
    Envelope columns that a source lacks are NULL.
    """
    bare = [c for c in CARRIED if c not in deliveries.columns]
    deliveries = deliveries.withColumns({c: F.lit(None).cast("string") for c in bare}) if bare else deliveries
    event = F.from_json(
        "data", wire_schema(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    )
    parsed = computed_once(deliveries, "_e", event)
    values, checks = [], []
    for name, kind, need in FIELDS:
        text = F.col(f"_e.{name}") if need == "required" else F.col(f"_e.{name}.{kind}")
        value = text
        if name == "event_ts":
            value = F.timestamp_micros(text)
        elif name in WALL_CLOCK_FIELDS:
            value = _wall_clock(text)
        elif name in MONEY_FIELDS:
            value = text.try_cast("decimal(15,2)")
        values.append(value.alias(name))
        # Given but not readable: wrong text, or an object without the branch's name.
        if need == "nullable" or name in WALL_CLOCK_FIELDS or name in MONEY_FIELDS:
            given = F.col(f"_e.{name}").isNotNull()
            checks.append(F.when(given & F.col(f"_v.{name}").isNull(), F.lit(name)))
    typed = computed_once(parsed, "_v", F.struct(*values))
    absent = F.concat_ws(
        ",", *[F.when(F.col(f"_e.{n}").isNull(), F.lit(n)) for n in REQUIRED_FIELDS]
    )
    unreadable = F.concat_ws(",", *checks)
    error = (
        F.when(F.col("data").isNull() | F.col("_e._broken").isNotNull(), "not an event")
        .when(absent != "", F.concat(F.lit("missing: "), absent))
        .when(unreadable != "", F.concat(F.lit("unreadable: "), unreadable))
    )
    judged = computed_once(typed, "contract_error", error)
    return judged.select(*deliveries.columns, "_v.*", "contract_error")
