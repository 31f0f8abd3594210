"""Monthly source files: listing, manifest, schema survey, and reading many eras as one frame."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.functions.contract import TRIPS, Contract

MONTH_IN_NAME = r"(\d{4}-\d{2})"
FOOTER_SCHEMA = "path string, rows bigint, columns array<struct<name string, type string>>, sha256 string"


class UnreadableFiles(ValueError):
    """Some of the files to be read are not Parquet."""


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """path, bytes and time of change of every file below `folder`; contents are pruned and never read.

    Files of no bytes at all are passed over, as every Spark source does.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return listed.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))


def file_period(path: Column) -> Column:
    """YYYY-MM in the file's name, or its stem when the name has no month."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    month = F.regexp_extract(name, MONTH_IN_NAME, 1)
    return F.when(month != "", month).otherwise(F.regexp_replace(name, r"\.[^.]*$", ""))


def file_table(path: Column) -> Column:
    """The table a file belongs to: the folder `name.parquet` it lies in, else the file's own period or stem."""
    folder = F.regexp_extract(path, r"([^/]+)\.parquet/[^/]+$", 1)
    return F.when(folder != "", folder).otherwise(file_period(path))


def _open(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _footer(handle) -> bytes:
    """The last bytes of a file, with its footer. An I/O error shows here, fails the task, and is retried."""
    size = handle.size()
    handle.seek(max(0, size - 8))
    tail = handle.read()
    if len(tail) < 8 or tail[4:] != b"PAR1":
        return tail
    length = min(size, int.from_bytes(tail[:4], "little") + 8)
    handle.seek(size - length)
    return handle.read()


def _parsed(footer: bytes):
    """Rows and fields; None when the bytes are no footer, whatever the parser makes of them."""
    import pyarrow.parquet as pq

    try:
        found = pq.ParquetFile(pa.BufferReader(b"PAR1" + footer))
        return found.metadata.num_rows, [{"name": f.name, "type": str(f.type)} for f in found.schema_arrow]
    except Exception:  # noqa: BLE001 - from memory: only the bytes can be at fault
        return None


def _describe(with_digest: bool):
    """One output row per file: footer facts, and the digest streamed in 4 MiB pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                with _open(path) as handle:
                    digest = None
                    if with_digest:
                        sha = hashlib.sha256()
                        while piece := handle.read(1 << 22):
                            sha.update(piece)
                        digest = sha.hexdigest()
                    rows.append((path, *(_parsed(_footer(handle)) or (None, None)), digest))
            names = ("path", "rows", "columns", "sha256")
            yield pa.RecordBatch.from_pylist(
                [dict(zip(names, r, strict=True)) for r in rows],
                schema=pa.schema(
                    [
                        ("path", pa.string()),
                        ("rows", pa.int64()),
                        (
                            "columns",
                            pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])),
                        ),
                        ("sha256", pa.string()),
                    ]
                ),
            )

    return run


def footers(files: DataFrame, *, digest: bool = False) -> DataFrame:
    """Footer facts per file, read in parallel; only a digest reads more than the footer."""
    # A stated number: paths are tiny, and adaptive execution would merge them into one task.
    tasks = 4 * files.sparkSession.sparkContext.defaultParallelism
    paths = files.select("path").repartition(tasks, "path")
    return paths.mapInArrow(_describe(digest), FOOTER_SCHEMA)


def manifest(files: DataFrame) -> DataFrame:
    """Bytes, digest, rows and verdict per file; unreadable and empty files are told apart."""
    facts = footers(files, digest=True).select("path", "rows", "sha256")
    verdict = (
        F.when(F.col("rows").isNull(), "unreadable").when(F.col("rows") == 0, "empty").otherwise("ok")
    )
    return files.join(facts, "path").select(
        "path",
        file_period(F.col("path")).alias("period"),
        "bytes",
        "sha256",
        "rows",
        verdict.alias("status"),
    )


def schema_survey(files: DataFrame) -> DataFrame:
    """Per column and physical type: in how many files, first and last period."""
    facts = footers(files).withColumn("period", file_period(F.col("path")))
    return (
        facts.select("period", F.explode("columns").alias("c"))
        .groupBy(F.col("c.name").alias("column"), F.col("c.type").alias("type"))
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.min("period").alias("first_period"),
            F.max("period").alias("last_period"),
        )
    )


def rows_by_year(files: DataFrame) -> DataFrame:
    facts = footers(files).withColumn("period", file_period(F.col("path")))
    return facts.groupBy(F.substring("period", 1, 4).alias("year")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")
    )


def stored_footers(spark: SparkSession, folder: str, store: str) -> DataFrame:
    """Footer facts of all files below `folder`, read for new and changed files only.

    `store` is a table of facts with each file's size and time of change; what it lacks is read and added.
    """
    from monthlake.sources import fs

    found = list_files(spark, folder)
    key = ["path", "bytes", "changed"]
    if fs.exists(spark, f"{store}/_SUCCESS"):
        missing = found.join(spark.read.parquet(store).select(*key), key, "left_anti")
    else:
        missing = found
    fresh = footers(missing).join(missing, "path").select(*key, "rows", "columns")
    fresh.write.mode("append").parquet(store)
    return spark.read.parquet(store).join(found, key, "left_semi").dropDuplicates(["path"])


def _name_pattern(parts: list[str]) -> str:
    """A glob for files whose names hold one of the parts."""
    return "*{" + ",".join(sorted(parts)) + "}*"


def read_months(
    spark: SparkSession,
    folder: str,
    *,
    processed_at: datetime | Column,
    contract: Contract = TRIPS,
    files: DataFrame | None = None,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Every month below `folder` in the contract's types, with the month taken from file names.

    `files` (with a path column) narrows it to some of the folder's files; `facts` are their footers, where they
    are known (`stored_footers`).

    Types drift between files, so files are grouped by footer schema ("eras"): one scan and one
    projection per era, however many months it spans. No schema merging. An era is read by a pattern of
    its months. The driver sees months and eras; it sees file names only of months whose files differ in schema, and
    of files whose name has no month.
    """
    if facts is None:
        facts = footers(list_files(spark, folder) if files is None else files)
    elif files is not None:
        facts = facts.join(files.select("path"), "path", "left_semi")
    named = facts.select(
        "path", "columns", file_period(F.col("path")).alias("period"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name")
    )
    bad = named.filter(F.col("columns").isNull()).select("path").orderBy("path").limit(20).collect()
    if bad:
        raise UnreadableFiles(f"unreadable source files: {[r.path for r in bad]}")
    months = named.groupBy("period").agg(F.count_distinct(F.to_json("columns")).alias("eras"))
    # A month of one schema is named by itself; one of several, file by file.
    whole = F.col("period").rlike(f"^{MONTH_IN_NAME}$") & (F.col("eras") == 1)
    part = F.when(whole, F.col("period")).otherwise(F.col("name"))
    eras = (
        named.join(months, "period")
        .select("columns", part.alias("part"))
        .distinct()
        .groupBy("columns")
        .agg(F.collect_list("part").alias("parts"))
        .collect()  # months, and names of the files of mixed months
    )
    clock = processed_at if isinstance(processed_at, Column) else F.lit(processed_at)
    month = F.to_date(
        F.concat(F.regexp_extract("_metadata.file_name", MONTH_IN_NAME, 1), F.lit("-01"))
    )
    frames = [
        contract.typed(
            spark.read.option("mergeSchema", "false")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", _name_pattern(era.parts))
            .parquet(folder),
            month.alias("source_month"),
            clock.alias("processed_at"),
        )
        for era in sorted(eras, key=lambda e: min(e.parts))
    ]
    return reduce(DataFrame.unionByName, frames)


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A lookup file with declared types. No nullValue: a literal 'N/A' stays text."""
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)


def ended_within(raw: DataFrame, start: str, minutes: int, column: str) -> DataFrame:
    """Trips whose meter stopped in [start, start + minutes), earliest first."""
    low = F.lit(start).cast("timestamp_ntz")
    high = low + F.expr(f"interval {minutes} minutes")
    return raw.filter((F.col(column) >= low) & (F.col(column) < high)).orderBy(column)
