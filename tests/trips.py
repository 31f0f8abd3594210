"""Trips for tests: one ordinary ride, variations of it, and files of the two physical eras."""

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq

MONTH = datetime(2021, 5, 1)
START = datetime(2021, 5, 11, 14, 30)
RIDE = timedelta(minutes=15)
# The raw file's own column names and an ordinary ride's values.
RIDE_VALUES = {
    "VendorID": 2, "tpep_pickup_datetime": START, "tpep_dropoff_datetime": START + RIDE,
    "passenger_count": 2, "trip_distance": 2.4, "RatecodeID": 1, "store_and_fwd_flag": "N",
    "PULocationID": 75, "DOLocationID": 41, "payment_type": 1,
}
AMOUNTS = {
    "fare_amount": 12.5, "extra": 1.0, "mta_tax": 0.5, "tip_amount": 2.5, "tolls_amount": 6.55,
    "improvement_surcharge": 1.0, "total_amount": 26.55, "congestion_surcharge": 2.75,
}
# Physical types of (old, new) files; every other column is a double in both.
ERAS = {
    "VendorID": (pa.int64(), pa.int32()),
    "PULocationID": (pa.int64(), pa.int32()),
    "DOLocationID": (pa.int64(), pa.int32()),
    "payment_type": (pa.int64(), pa.int64()),
    "passenger_count": (pa.float64(), pa.int64()),
    "RatecodeID": (pa.float64(), pa.int64()),
    "store_and_fwd_flag": (pa.string(), pa.large_string()),
    "tpep_pickup_datetime": (pa.timestamp("us"), pa.timestamp("us")),
    "tpep_dropoff_datetime": (pa.timestamp("us"), pa.timestamp("us")),
}


def trip(**changes):
    return RIDE_VALUES | AMOUNTS | changes


def lasting(length, **changes):
    """A ride of that length from START."""
    return trip(tpep_dropoff_datetime=START + length, **changes)


def refund(row, **changes):
    back = {name: -row[name] for name in AMOUNTS if row[name] is not None}
    return row | back | changes


def era(rows, new=False):
    def cells(name, kind):
        values = [row[name] for row in rows]
        return [None if v is None else float(v) for v in values] if pa.types.is_floating(kind) else values

    columns = {}
    for name in RIDE_VALUES | AMOUNTS:
        kind = ERAS.get(name, (pa.float64(),) * 2)[new]
        columns[name] = pa.array(cells(name, kind), kind)
    fee = ("Airport_fee", pa.array([None] * len(rows), pa.float64())) if new else ("airport_fee", pa.nulls(len(rows)))
    return pa.table(columns | dict([fee]))


def write(table, path):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(table, path)
    return str(path)


def typed(spark, rows, tmp_path, month=f"{MONTH:%Y-%m-%d}", new=False):
    from pyspark.sql import functions as F

    from monthlake.functions.contract import TRIPS

    carried = {"source_month": (month, "date"), "processed_at": ("2025-03-04 05:06:07", "timestamp")}
    raw = spark.read.parquet(write(era(rows, new), tmp_path / "raw.parquet"))
    return TRIPS.typed(raw, *[F.lit(v).cast(t).alias(n) for n, (v, t) in carried.items()])
