"""The declared data tests of all tables, and a runner that counts violations per test.

Not-null and accepted-value tests of a table share one aggregate over it; a uniqueness test is one
grouped count that combines on the map side; a relationship test counts child values before they
meet their parents. Nothing but one row per test leaves the cluster.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.operators import checks
from monthlake.operators.rules import BATCH_ONLY, RULE_CODES
from monthlake.plans.star import AIRPORTS

# Which columns of which table are tested, and the values that are accepted.
NOT_NULL = {
    "staging": ("trip_id", "pickup_partition_ts", "pickup_datetime", "dropoff_datetime", "vendor_id",
                "ratecode_id", "payment_type", "pu_location_id", "do_location_id", "total_amount"),
    "fact": ("trip_id", "pickup_partition_ts", "pickup_date", "has_quality_flag"),
    "dim_date": ("date_day",),
    "dim_zone": ("location_id",),
    "dim_vendor": ("vendor_id",),
    "dim_ratecode": ("ratecode_id",),
    "dim_payment_type": ("payment_type",),
    "events": ("event_id",),
    "live": ("trip_id",),
    "mark": ("batch_high_water",),
    "daily": ("pickup_date", "trips"),
    "hourly": ("pickup_hour",),
    "flows": ("month_start", "trips"),
    "airport": ("airport_code",),
    "daily_overview": ("pickup_date",),
    "hourly_profile": ("trips",),
    "zone_flows_named": ("trips",),
    "borough_flows": ("trips",),
    "seed_zones": ("location_id",),
    "seed_vendors": ("vendor_id",),
    "seed_rate_codes": ("ratecode_id",),
    "seed_payment_types": ("payment_type",),
}
UNIQUE = {
    "staging": "trip_id", "fact": "trip_id", "dim_date": "date_day", "dim_zone": "location_id",
    "dim_vendor": "vendor_id", "dim_ratecode": "ratecode_id", "dim_payment_type": "payment_type",
    "events": "event_id", "live": "trip_id", "daily": "pickup_date", "daily_overview": "pickup_date",
    "seed_zones": "location_id", "seed_vendors": "vendor_id", "seed_rate_codes": "ratecode_id",
    "seed_payment_types": "payment_type",
}
# Columns that the tests and the marts read: of the fact (and staging), of judged events, and of the live fact.
FACT_READS = (
    "trip_id", "pickup_partition_ts", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour",
    "trip_duration_seconds", "vendor_id", "ratecode_id", "payment_type", "pu_location_id", "do_location_id",
    "passenger_count", "trip_distance_miles", "fare_amount", "tip_amount", "total_amount", "has_quality_flag",
)
EVENT_READS = ("event_id", "reject_reason", "pu_location_id", "vendor_id")
LIVE_READS = ("trip_id", "pu_location_id", "vendor_id")
AIRPORT_CODES = sorted(code for code, _ in AIRPORTS.values())
ACCEPTED = {
    ("staging", "vendor_id"): [1, 2, 4, 5, 6, 7],
    ("staging", "ratecode_id"): [1, 2, 3, 4, 5, 6, 99],
    ("staging", "payment_type"): [0, 1, 2, 3, 4, 5, 6],
    ("events", "reject_reason"): [c for c in RULE_CODES if c not in BATCH_ONLY],
    ("hourly", "pickup_hour"): list(range(24)),
    ("airport", "airport_code"): AIRPORT_CODES,
    ("airport", "direction"): ["dropoff", "pickup"],
    ("airport_monthly", "airport_code"): AIRPORT_CODES,
}
PARENTS = {
    ("fact", "pickup_date"): ("dim_date", "date_day"),
    ("fact", "vendor_id"): ("dim_vendor", "vendor_id"),
    ("fact", "ratecode_id"): ("dim_ratecode", "ratecode_id"),
    ("fact", "payment_type"): ("dim_payment_type", "payment_type"),
    ("fact", "pu_location_id"): ("dim_zone", "location_id"),
    ("fact", "do_location_id"): ("dim_zone", "location_id"),
    ("live", "pu_location_id"): ("dim_zone", "location_id"),
    ("live", "vendor_id"): ("dim_vendor", "vendor_id"),
}
SINGLE: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "mart_reconciles": lambda t: checks.mart_reconciles(t["daily"], t["fact"]),
    "dropoff_not_before_pickup": lambda t: checks.dropoff_before_pickup(t["staging"]),
    "fact_matches_staging": lambda t: checks.fact_matches_staging(t["fact"], t["staging"]),
    "recorded_within_total": lambda t: checks.recorded_above_total(t["daily"]),
}
COLUMNS = ("table_name", "column_name", "test", "violations")


def _row(table: str, column: str | None, test: str, violations):
    values = (F.lit(table), F.lit(column).cast("string"), F.lit(test), violations.cast("long"))
    return F.struct(*[v.alias(n) for v, n in zip(values, COLUMNS, strict=True)])


def _one_pass(table: str, df: DataFrame) -> DataFrame | None:
    conditions = {(c, "not_null"): F.col(c).isNull() for c in NOT_NULL.get(table, ())}
    conditions |= {
        (c, "accepted_values"): F.col(c).isNotNull() & ~F.col(c).isin(values)
        for (t, c), values in ACCEPTED.items()
        if t == table
    }
    if not conditions:
        return None
    counted = df.agg(*[F.count_if(v).alias(f"{c}.{test}") for (c, test), v in conditions.items()])
    rows = [_row(table, c, test, F.col(f"`{c}.{test}`")) for c, test in conditions]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _counted(violations: DataFrame, table: str, column: str | None, test: str) -> DataFrame:
    n = violations.agg(F.count(F.lit(1)).alias("n"))
    return n.select(_row(table, column, test, F.col("n")).alias("r")).select("r.*")


def run_suite(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, column_name, test, violations: one row per declared test (values, not rows, for
    unique and relationships)."""
    parts = [p for name, df in tables.items() if (p := _one_pass(name, df)) is not None]
    parts += [_counted(checks.unique(tables[t], c), t, c, "unique") for t, c in UNIQUE.items()]
    parts += [
        _counted(checks.relationships(tables[t], c, tables[p], k), t, c, "relationships")
        for (t, c), (p, k) in PARENTS.items()
    ]
    parts += [_counted(check(tables), "all", None, name) for name, check in SINGLE.items()]
    return reduce(DataFrame.unionByName, parts)
