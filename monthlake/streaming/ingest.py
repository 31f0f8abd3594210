"""From the topic to the delivery table: one pass, every delivery kept, bad ones set aside.

The sink is a partitioned Parquet table written by foreachBatch. Its last partition keys are the
stream and the batch: a batch that is run again after a failure overwrites its own directories, and
never those of another stream or of an earlier checkpoint. A stream's name is made once and kept in
its checkpoint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monthlake.sources import fs
from monthlake.streaming.wire import CARRIED, ENVELOPE, FIELDS, decode

OUTCOMES = ("delivered", "refused")
DELIVERED = ["message_id", "publish_time", *[n for n, _, _ in FIELDS], *CARRIED]


def json_source(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Envelopes as JSON files; a fixed schema, never inferred."""
    return (
        spark.readStream.schema(ENVELOPE)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The same envelope from a Kafka topic (needs the spark-sql-kafka package)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("includeHeaders", "true")
        .load()
    )
    return raw.select(
        F.concat_ws("-", F.col("topic"), F.col("partition"), F.col("offset")).alias("message_id"),
        F.col("timestamp").alias("publish_time"),
        F.col("value").cast("string").alias("data"),
        F.col("topic").alias("subscription_name"),
        F.to_json(F.map_from_entries(F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string"))))).alias("attributes"),
    )


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name kept in the checkpoint; a new one for a new or reset checkpoint."""
    path = f"{checkpoint}/stream_name"
    if not fs.exists(spark, f"{path}/_SUCCESS"):
        made = spark.createDataFrame([(uuid.uuid4().hex,)], "name string")
        made.coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).head().value


def start_ingest(deliveries: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Split by contract into table/outcome=delivered and table/outcome=refused."""

    stream = stream_name(deliveries.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = decode(batch).withColumns(
            {
                "outcome": F.when(F.col("contract_error").isNull(), "delivered").otherwise(
                    "refused"
                ),
                "publish_date": F.to_date("publish_time"),
                "stream": F.lit(stream),
                "batch_id": F.lit(batch_id),
                # A delivered event lies in its columns; its text would be most of the table, and no reader takes it.
                "data": F.when(F.col("contract_error").isNotNull(), F.col("data")),
            }
        )
        (
            judged.sortWithinPartitions("outcome", "publish_date", "pu_location_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy("outcome", "publish_date", "stream", "batch_id")
            .parquet(table)
        )

    return (
        deliveries.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _outcome(spark: SparkSession, table: str, outcome: str) -> DataFrame | None:
    """Rows of an outcome that readers may see (see compaction); None before the first."""
    from monthlake.streaming import compaction  # compaction builds on this module

    path = f"{table}/outcome={outcome}"
    if not fs.child_dirs(spark, path):
        return None
    return spark.read.parquet(path).filter(compaction.visible(spark, table, outcome))


def delivered(spark: SparkSession, table: str) -> DataFrame:
    """Every delivery that fits the contract, repeats included, with its publish_date."""
    rows = _outcome(spark, table, "delivered")
    if rows is None:
        nothing = decode(spark.createDataFrame([], ENVELOPE)).select(*DELIVERED)
        return nothing.withColumn("publish_date", F.to_date("publish_time"))
    return rows.select(*DELIVERED, "publish_date")


def refused(spark: SparkSession, table: str) -> DataFrame:
    """Deliveries that break the contract: raw text and the reason."""
    rows = _outcome(spark, table, "refused")
    if rows is None:
        return spark.createDataFrame(
            [], f"{ENVELOPE}, contract_error string"
        )
    return rows.select("message_id", "publish_time", "data", *CARRIED, "contract_error")
