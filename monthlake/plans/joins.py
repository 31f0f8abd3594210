"""Joining a dimension: broadcast only after its size was checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def dimension(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint when it has at most max_rows rows.

    The look stops after max_rows + 1 rows. A larger side keeps no hint: the planner then takes a
    shuffled join, with adaptive skew handling.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df
