"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings; safe to set on a session somebody else built.
SETTINGS = {
    # Source timestamps carry no zone. Under UTC a wall-clock/instant cast changes nothing.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Generated methods beyond 8,000 bytes are never compiled by the JVM: such stages run as single, compiled projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "monthlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone != "UTC":
        raise RuntimeError(f"the session time zone must be UTC, not {zone}")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors can reach, under the cluster's spark.checkpoint.dir.

    Only a local[...] session without that setting gets a folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
