"""The schema contract: one canonical shape for every drifting monthly file."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthlake.functions.columns import row_fingerprint

# Source column (any case), canonical column, type, whether a file may lack it.
# The order is the output order and the order the fingerprint reads.
TRIP_COLUMNS = (
    ("VendorID", "vendor_id", "bigint", False),
    ("tpep_pickup_datetime", "pickup_datetime", "timestamp_ntz", False),
    ("tpep_dropoff_datetime", "dropoff_datetime", "timestamp_ntz", False),
    ("passenger_count", "passenger_count", "bigint", False),
    ("trip_distance", "trip_distance", "double", False),
    ("RatecodeID", "ratecode_id", "bigint", False),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string", False),
    ("PULocationID", "pu_location_id", "bigint", False),
    ("DOLocationID", "do_location_id", "bigint", False),
    ("payment_type", "payment_type", "bigint", False),
    ("fare_amount", "fare_amount", "decimal(15,2)", False),
    ("extra", "extra", "decimal(15,2)", False),
    ("mta_tax", "mta_tax", "decimal(15,2)", False),
    ("tip_amount", "tip_amount", "decimal(15,2)", False),
    ("tolls_amount", "tolls_amount", "decimal(15,2)", False),
    ("improvement_surcharge", "improvement_surcharge", "decimal(15,2)", False),
    ("total_amount", "total_amount", "decimal(15,2)", False),
    ("congestion_surcharge", "congestion_surcharge", "decimal(15,2)", False),
    ("airport_fee", "airport_fee", "decimal(15,2)", True),
    ("cbd_congestion_fee", "cbd_congestion_fee", "decimal(15,2)", True),
)
# What a missing value becomes after the fingerprint is taken.
TRIP_FILLS = {
    "ratecode_id": "99",
    "congestion_surcharge": "0",
    "airport_fee": "0",
    "cbd_congestion_fee": "0",
}
FLAGS = ("is_zero_distance", "is_zero_duration", "is_long_duration", "is_near_duplicate")
REASONS = ("reject_reason", "reject_reasons")


class ContractViolation(ValueError):
    """A file's columns do not fit the contract; the whole month is refused."""


@dataclass(frozen=True)
class SourceColumn:
    source: str
    name: str
    type: str
    optional: bool = False


@dataclass(frozen=True)
class Contract:
    columns: tuple[SourceColumn, ...]
    fills: dict[str, str]

    @classmethod
    def of(cls, rows: tuple[tuple[str, str, str, bool], ...], fills: dict[str, str]) -> Contract:
        return cls(tuple(SourceColumn(*row) for row in rows), fills)

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)

    @property
    def money(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if c.type.startswith("decimal"))

    def _faults(self, by_key: dict[str, list[str]]) -> list[str]:
        """What is wrong with a file's column names, grouped by their lower case; empty when nothing is."""
        keys = {c.source.lower(): c for c in self.columns}
        twice = [f"columns {' and '.join(map(repr, v))} differ only in case" for v in by_key.values() if len(v) > 1]
        unknown = sorted(v[0] for k, v in by_key.items() if k not in keys)
        missing = sorted(c.source for k, c in keys.items() if not (c.optional or k in by_key))
        told = (("unknown columns", unknown), ("required but missing", missing))
        return twice + [f"{what} {names}" for what, names in told if names]

    def resolve(self, found: list[str]) -> dict[str, str]:
        """Canonical name -> the file's own column name. Reads names only, never data."""
        by_key: dict[str, list[str]] = {}
        for column in found:
            by_key.setdefault(column.lower(), []).append(column)
        if faults := self._faults(by_key):
            raise ContractViolation("; ".join(faults))
        return {c.name: by_key[key][0] for c in self.columns if (key := c.source.lower()) in by_key}

    def typed(self, raw: DataFrame, *carry: Column) -> DataFrame:
        """Rename and cast; an absent optional column becomes NULL of its type.

        `carry` columns (such as the source month) travel along unchanged. ANSI casts raise on
        overflow instead of losing a value.
        """
        own = self.resolve([c for c in raw.columns if not c.startswith("_")])
        present = raw.select(*[F.col(f"`{column}`").alias(name) for name, column in own.items()], *carry)
        gaps = {c.name: F.lit(None) for c in self.columns if c.name not in own}
        kinds = {c.name: F.col(c.name).cast(c.type) for c in self.columns}
        carried = present.columns[len(own) :]
        return present.withColumns(gaps).withColumns(kinds).select(*self.names, *carried)

    def identified(self, typed: DataFrame) -> DataFrame:
        """Add trip_id from the values as published, then apply the fills."""
        types = {c.name: c.type for c in self.columns}
        filled = [
            F.coalesce(F.col(n), F.lit(self.fills[n]).cast(types[n])).alias(n)
            if n in self.fills
            else F.col(n)
            for n in self.names
        ]
        rest = [F.col(c) for c in typed.columns if c not in types]
        return typed.select(row_fingerprint(self.names).alias("trip_id"), *filled, *rest)

    def canonicalize(
        self, raw: DataFrame, *, source_month: date | Column, processed_at: datetime | Column
    ) -> DataFrame:
        month = source_month if isinstance(source_month, Column) else F.lit(source_month)
        clock = processed_at if isinstance(processed_at, Column) else F.lit(processed_at)
        lineage = (month.cast("date").alias("source_month"), clock.alias("processed_at"))
        return self.identified(self.typed(raw, *lineage))

    def core_schema(self) -> list[tuple[str, str]]:
        return [
            ("trip_id", "string"),
            *((c.name, c.type) for c in self.columns),
            ("source_month", "date"),
            ("processed_at", "timestamp"),
        ]

    def curated_schema(self) -> list[tuple[str, str]]:
        return [*self.core_schema(), *((f, "boolean") for f in FLAGS)]

    def quarantine_schema(self) -> list[tuple[str, str]]:
        return [
            *self.core_schema(),
            ("reject_reason", "string"),
            ("reject_reasons", "array<string>"),
        ]


TRIPS = Contract.of(TRIP_COLUMNS, TRIP_FILLS)


def check_schema(found: T.StructType, declared: list[tuple[str, str]], what: str) -> None:
    """Names, order and types must equal the declared contract before anything is written."""
    ours = [(f.name, f.dataType.simpleString()) for f in found.fields]
    wrong = [(a, b) for a, b in zip(ours, declared, strict=False) if a != b]
    if wrong or len(ours) != len(declared):
        raise ContractViolation(
            f"{what}: {len(ours)} columns against {len(declared)} declared, differing {wrong}"
        )


def select_declared(df: DataFrame, declared: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[name for name, _ in declared])
