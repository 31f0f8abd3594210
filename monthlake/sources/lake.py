"""Partitioned Parquet tables: swap whole partitions, clear empty ones, count, verify."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from monthlake.sources import fs


class SchemaChanged(RuntimeError):
    """An incremental write does not have the table's schema."""


class LoadMismatch(RuntimeError):
    """A loaded partition disagrees with the month's report."""


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def swap_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    *,
    sort: Sequence[str] = (),
    full_refresh: bool = False,
    observed: dict[str, Column] | None = None,
    grouped: bool = False,
) -> dict[str, int]:
    """Replace exactly the partitions present in `df`; with full_refresh, the whole table.

    The rebalance gives each partition files of a good size and splits a partition that holds a
    large share of the rows; sorting inside them lets row groups be skipped later.

    `observed` are aggregates over the rows as they go to the writer; their values are returned. They are
    measured behind the last exchange, in the tasks that write, so a task that runs again is not counted twice.

    `grouped`: the rows are read from a table of the same partitions, whose files are of a good size already; each task
    writes the partitions it reads, and no row is exchanged.
    """
    shaped = df if grouped else df.hint("rebalance", *by)
    if sort:
        shaped = shaped.sortWithinPartitions(*by, *sort)
    measured = Observation()
    if observed:
        shaped = shaped.observe(measured, *[c.alias(n) for n, c in observed.items()])
    mode = "static" if full_refresh else "dynamic"
    (
        shaped.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*by)
        .parquet(path)
    )
    return measured.get if observed else {}


def clear_partition(spark: SparkSession, path: str, **values: str) -> bool:
    """Delete one partition: an empty frame leaves old rows under dynamic overwrite."""
    where = "/".join(f"{k}={v}" for k, v in values.items())
    return fs.delete(spark, f"{path}/{where}")


def guard_schema(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Fail an incremental write whose columns or types differ from the table's."""
    if not fs.exists(spark, path):
        return
    ours = sorted((f.name, f.dataType.simpleString()) for f in df.schema)
    theirs = sorted((f.name, f.dataType.simpleString()) for f in read_table(spark, path).schema)
    if ours != theirs:
        raise SchemaChanged(f"{path}: {sorted(set(ours) ^ set(theirs))}")


def partition_counts(tables: dict[str, DataFrame], month: str = "source_month") -> DataFrame:
    """Rows per (table, partition); only footers and directory names are read."""
    frames = [
        df.groupBy(F.col(month).alias("partition"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "partition", "rows")
        for name, df in tables.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def done_months(reports: DataFrame, counts: DataFrame, curated: str, quarantine: str) -> DataFrame:
    """Per reported month whether the tables hold what the report says.

    A month without curated rows in the table is not done, even for a report of 0; a month without
    quarantine rows has no partition, which equals 0.
    """
    rows = F.col("rows")
    by_month = counts.groupBy(F.col("partition").alias("month_start")).agg(
        F.sum(F.when(F.col("table_name") == curated, rows)).alias("have_curated"),
        F.coalesce(
            F.sum(F.when(F.col("table_name") == quarantine, rows)), F.lit(0).cast("long")
        ).alias("have_quarantined"),
    )
    joined = reports.join(by_month, "month_start", "left")
    done = F.col("have_curated").eqNullSafe(F.col("curated_rows")) & (
        F.coalesce("have_quarantined", F.lit(0)) == F.col("quarantined_rows")
    )
    return joined.select("month_start", "curated_rows", "quarantined_rows", done.alias("done"))


def verify_load(reports: DataFrame, loaded: DataFrame, expected: str) -> DataFrame:
    """Months whose loaded rows differ from the report, either way round; empty when all is well."""
    have = loaded.groupBy(F.col("source_month").alias("month_start")).agg(
        F.count(F.lit(1)).alias("loaded_rows")
    )
    want = reports.select("month_start", F.col(expected).alias("expected_rows"))
    both = want.join(have, "month_start", "full_outer").select(
        "month_start",
        F.coalesce("expected_rows", F.lit(0).cast("long")).alias("expected_rows"),
        F.coalesce("loaded_rows", F.lit(0).cast("long")).alias("loaded_rows"),
    )
    return both.filter(F.col("expected_rows") != F.col("loaded_rows"))


def expire_days(
    spark: SparkSession, path: str, as_of: date, days: int = 90, key: str = "publish_date"
) -> list[str]:
    """Drop day partitions older than `days`; returns the days dropped. Touches names only."""
    oldest_kept = as_of - timedelta(days=days)
    gone = []
    for name in fs.child_dirs(spark, path):
        column, _, value = name.partition("=")
        if column == key and date.fromisoformat(value) < oldest_kept:
            fs.delete(spark, f"{path}/{name}")
            gone.append(value)
    return gone


def newest(spark: SparkSession, path: str, key: str) -> date | None:
    """The largest value of a date partition, from directory names alone."""
    found = [n.partition("=") for n in fs.child_dirs(spark, path)]
    days = [v for k, _, v in found if k == key and v != "__HIVE_DEFAULT_PARTITION__"]
    return max(map(date.fromisoformat, days), default=None)


def within(column: Column, first: date, last: date) -> Column:
    """Half-open range on the bare partition column, so directories are pruned."""
    return (column >= F.lit(first)) & (column < F.lit(last))
