"""Quantiles of any range of months from sketches that are written once a month.

A KLL sketch of each measure and month is a few kilobytes. Merging the sketches of a range gives its
quantiles without a look at its rows; only a month that is processed again is sketched again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.operators.profile import minutes_between, plausible_trips
from monthlake.sources import lake

K = 4096
#: Rank error of a merged sketch of this K, with better than 99 % confidence.
RANK_ERROR = 0.002


def measures() -> dict[str, Column]:
    """What is sketched. Speed is of plausible trips alone, NULL for the others."""
    return {
        "minutes": minutes_between("pickup_datetime", "dropoff_datetime"),
        "miles": F.col("trip_distance"),
        "fare": F.col("fare_amount").cast("double"),
        "mph": F.col("mph"),
    }


def month_sketches(trips: DataFrame, k: int = K) -> DataFrame:
    """source_month, measure, n, sketch: one row for each month and measure that has values."""
    measured = plausible_trips(trips).select(
        "source_month", *[v.cast("double").alias(m) for m, v in measures().items()]
    )
    by_month = measured.groupBy("source_month").agg(
        *[F.kll_sketch_agg_double(F.col(m), k).alias(f"s_{m}") for m in measures()],
        *[F.count(m).alias(f"n_{m}") for m in measures()],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(m).alias("measure"), F.col(f"n_{m}").alias("n"), F.col(f"s_{m}").alias("sketch"))
            for m in measures()
        ]
    )
    return by_month.select("source_month", F.explode(pairs).alias("p")).select("source_month", "p.*").filter("n > 0")


def store(trips: DataFrame, path: str, k: int = K) -> None:
    """Write the sketches of the months in `trips`; other months' stay as they are."""
    lake.swap_partitions(month_sketches(trips, k), path, ["source_month"])


def quantiles(
    spark: SparkSession, path: str, points: list[float], first=None, last=None
) -> DataFrame:
    """measure, point, n, value over the months from `first` to before `last` (all without them)."""
    rows = lake.read_table(spark, path)
    if first is not None and last is not None:
        rows = rows.filter(lake.within(F.col("source_month"), first, last))
    merged = rows.groupBy("measure").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    at = F.array(
        *[
            F.struct(F.lit(float(p)).alias("point"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
            for p in points
        ]
    )
    n = F.kll_sketch_get_n_double("sketch").alias("n")
    return merged.select("measure", n, F.explode(at).alias("at")).select("measure", "at.point", "n", "at.value")


def rank_errors(trips: DataFrame, found: DataFrame) -> DataFrame:
    """`found` with the exact share of values below and up to each quantile, and its rank error.

    A quantile that many rows share covers a range of ranks; the error is the distance to that range.
    """
    quantiles_found = found.collect()  # a row for each measure and point
    if not quantiles_found:
        return found.withColumns({c: F.lit(None).cast("double") for c in ("below", "upto", "rank_error")})
    values = {m: v.cast("double") for m, v in measures().items()}
    # One pass of plain counts: rows are neither multiplied by measures nor joined to the quantiles.
    counts = plausible_trips(trips).agg(
        F.array(
            *[
                F.struct(
                    *[F.lit(r[c]).cast(found.schema[c].dataType).alias(c) for c in found.columns],
                    F.count(values[r.measure]).alias("_n"),
                    F.count_if(values[r.measure] < r.value).alias("_below"),
                    F.count_if(values[r.measure] <= r.value).alias("_upto"),
                )
                for r in quantiles_found
            ]
        ).alias("told")
    )
    told = counts.select(F.explode("told").alias("t")).select("t.*").filter("_n > 0")
    shares = told.withColumns({"below": F.col("_below") / F.col("_n"), "upto": F.col("_upto") / F.col("_n")})
    error = F.greatest(F.col("below") - F.col("point"), F.col("point") - F.col("upto"), F.lit(0.0))
    return shares.select(*found.columns, "below", "upto", error.alias("rank_error"))
