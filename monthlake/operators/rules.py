"""One registry of hard rules and soft flags, used by the monthly job and by the live view.

Codes, their order and their limits are fixed values; the predicates are written once, so the
batch and the stream cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthlake.functions.columns import any_of, whole_seconds
from monthlake.functions.contract import TRIPS

# Reason codes in precedence order.
RULE_CODES = (
    "missing_required_field",
    "invalid_location_id",
    "pickup_outside_source_month",
    "dropoff_before_pickup",
    "duration_over_24h",
    "negative_distance",
    "distance_over_500_miles",
    "implied_speed_over_100_mph",
    "amount_out_of_range",
    "reversal_negative_row",
    "reversed_by_negative_row",
    "negative_amount_unmatched",
    "duplicate_row",
)
# Codes that need a source file, a partner row or a copy, so never judge an event.
BATCH_ONLY = (
    "pickup_outside_source_month",
    "reversal_negative_row",
    "reversed_by_negative_row",
    "duplicate_row",
)
# Columns that must be present, and the identity of a trip.
REQUIRED = (
    "vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id",
    "payment_type", "trip_distance", "fare_amount", "total_amount",
)
IDENTITY = (
    "vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id",
)


@dataclass(frozen=True)
class Limits:
    """Fixed values, changeable for other data."""

    zones: tuple[int, int] = (1, 265)
    max_hours: int = 24
    max_miles: int = 500
    max_mph: int = 100
    max_amount: int = 10_000
    long_hours: int = 3


def is_negative() -> Column:
    """True when any amount is below zero; unknown amounts do not count."""
    return F.coalesce(any_of(F.col(m) < 0 for m in TRIPS.money), F.lit(False))


def row_rules(limits: Limits = Limits()) -> dict[str, Column]:
    """Predicates over one row alone. A NULL predicate means the rule did not fail."""
    pickup, dropoff, miles = (
        F.col("pickup_datetime"), F.col("dropoff_datetime"), F.col("trip_distance"),
    )
    seconds = whole_seconds(pickup, dropoff)
    too_fast = (seconds > 0) & (miles / (seconds / 3600) > limits.max_mph)
    return {
        "missing_required_field": any_of(F.col(c).isNull() for c in REQUIRED),
        "invalid_location_id": any_of(
            ~F.col(z).between(*limits.zones) for z in ("pu_location_id", "do_location_id")
        ),
        "dropoff_before_pickup": dropoff < pickup,
        "duration_over_24h": dropoff - pickup > F.expr(f"interval {limits.max_hours} hours"),
        "negative_distance": miles < 0,
        "distance_over_500_miles": miles > limits.max_miles,
        "implied_speed_over_100_mph": too_fast | ((seconds == 0) & (miles > 0)),
        "amount_out_of_range": any_of(F.abs(F.col(m)) > limits.max_amount for m in TRIPS.money),
    }


def month_rule(month: str = "source_month") -> Column:
    """Outside the half-open month; the month is a column, so many months share one job."""
    start = F.col(month).cast("timestamp_ntz")
    end = F.add_months(F.col(month), 1).cast("timestamp_ntz")
    return (F.col("pickup_datetime") < start) | (F.col("pickup_datetime") >= end)


def batch_rules(negative: Column, paired: Column, limits: Limits = Limits()) -> dict[str, Column]:
    """Every rule but duplicate_row, in precedence order."""
    known = {
        **row_rules(limits),
        "pickup_outside_source_month": month_rule(),
        "reversal_negative_row": negative & paired,
        "reversed_by_negative_row": ~negative & paired,
        "negative_amount_unmatched": negative & ~paired,
    }
    return {code: known[code] for code in RULE_CODES if code in known}


def stream_rules(limits: Limits = Limits()) -> dict[str, Column]:
    """The subset one event can fail; every negative amount is unmatched there."""
    known = {**row_rules(limits), "negative_amount_unmatched": is_negative()}
    return {code: known[code] for code in RULE_CODES if code not in BATCH_ONLY}


def failed_codes(rules: dict[str, Column]) -> Column:
    """All failed codes in precedence order, comma-separated; empty when none failed.

    Text, not array_compact: that one runs a lambda per row outside generated code.
    """
    return F.concat_ws(",", *[F.when(c, F.lit(code)) for code, c in rules.items()])


def reason_columns(failed: str, duplicate: Column) -> dict[str, Column]:
    """reject_reasons (all codes) and reject_reason (the first, NULL when the row passes)."""
    code = F.lit("duplicate_row")
    none = F.col(failed) == ""
    return {
        "reject_reason": F.when(duplicate, code).when(
            ~none, F.substring_index(F.col(failed), ",", 1)
        ),
        "reject_reasons": F.when(duplicate, F.array(code))
        .when(none, F.array().cast("array<string>"))
        .otherwise(F.split(failed, ",")),
    }


def first_failed(rules: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(c, F.lit(code)) for code, c in rules.items()])


def row_flags(limits: Limits = Limits()) -> dict[str, Column]:
    """Soft flags that need one row alone."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return {
        "is_zero_distance": F.col("trip_distance") == 0,
        "is_zero_duration": dropoff == pickup,
        "is_long_duration": dropoff - pickup > F.expr(f"interval {limits.long_hours} hours"),
    }


def has_any_flag(flags: tuple[str, ...]) -> Column:
    return F.coalesce(any_of(F.col(f) for f in flags), F.lit(False))
