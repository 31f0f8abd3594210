"""Data-quality counts per month, in one pass over the judged rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.functions.contract import FLAGS
from monthlake.operators.rules import RULE_CODES


def primary_counts(judged: DataFrame) -> DataFrame:
    """Rows per first reason; NULL is the curated part."""
    return judged.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


def rule_hits(judged: DataFrame) -> DataFrame:
    """Every failed rule counted, not only the first."""
    return (
        judged.select(F.explode("reject_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _present(counts: dict[str, Column]) -> Column:
    """Map of the counts above zero."""
    entries = F.array(
        *[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in sorted(counts.items())]
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0))


def quarantine_rate(quarantined: Column, source: Column) -> Column:
    rate = F.round(quarantined.cast("double") / source.cast("double"), 6)
    return F.when(source == 0, F.lit(0.0)).otherwise(rate)


def month_reports(judged: DataFrame) -> DataFrame:
    """One report per source month. All counts are buffers of a single grouped aggregate."""
    kept = F.col("reject_reason").isNull()
    aggs = {"source_rows": F.count(F.lit(1)), "curated_rows": F.count_if(kept)}
    for code in RULE_CODES:
        aggs[f"_first_{code}"] = F.count_if(F.col("reject_reason") == code)
        aggs[f"_hit_{code}"] = F.count_if(F.array_contains("reject_reasons", code))
    for flag in FLAGS:
        aggs[f"_{flag}"] = F.count_if(kept & F.col(flag))
    aggs["processed_at"] = F.max("processed_at")
    aggs["passenger_count_null_rows"] = F.count_if(F.col("passenger_count").isNull())
    wide = judged.groupBy("source_month").agg(*[a.alias(n) for n, a in aggs.items()])
    bad = F.col("source_rows") - F.col("curated_rows")
    return wide.select(
        F.col("source_month").alias("month_start"),
        "source_rows",
        "curated_rows",
        bad.alias("quarantined_rows"),
        quarantine_rate(bad, F.col("source_rows")).alias("quarantine_rate"),
        _present({c: F.col(f"_first_{c}") for c in RULE_CODES}).alias("reject_reason_counts"),
        _present({c: F.col(f"_hit_{c}") for c in RULE_CODES}).alias("rule_hit_counts"),
        F.create_map(*[x for f in FLAGS for x in (F.lit(f), F.col(f"_{f}"))]).alias(
            "soft_flag_counts"
        ),
        "passenger_count_null_rows",
        "processed_at",
    )


def rollup_totals(reports: DataFrame) -> DataFrame:
    """All months together: rows and overall quarantine rate."""
    sums = reports.agg(
        F.count(F.lit(1)).alias("months"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
            for c in ("source_rows", "curated_rows", "quarantined_rows")
        ],
    )
    return sums.withColumn(
        "quarantine_rate", quarantine_rate(F.col("quarantined_rows"), F.col("source_rows"))
    )


def rollup_counts(reports: DataFrame) -> DataFrame:
    """Sums of the per-reason and per-flag maps over all months."""
    parts = [
        reports.select(F.lit(kind).alias("kind"), F.explode(column).alias("name", "rows"))
        for kind, column in (("reason", "reject_reason_counts"), ("flag", "soft_flag_counts"))
    ]
    return (
        parts[0].unionByName(parts[1]).groupBy("kind", "name").agg(F.sum("rows").alias("rows"))
    )
