"""Folding the delivery table's many small directories, a finished day at a time.

The ingest writes a directory for each outcome, day, stream and batch. `compact` folds those of a day into a
few files of a good size, in a directory of the stream name `folded-<id>`, and retires the directories it
read. What readers see changes at one point only, when the marker file of the fold is renamed into place:

1. The folded rows are written. Without a marker, readers pass over them.
2. The marker appears. It lists the directories it replaces; readers now take the folded rows and pass over those.
3. The directories are deleted; then a second marker takes the place of the first, whose list is no longer needed.

A run that dies after 1 leaves rows nobody reads, one that dies after 2 leaves directories nobody reads;
the next run clears both. Only batches whose stream has committed them are folded, so none is ever
written again. Rows that arrive for a folded day later come in directories of their own, as before, and can be folded by
another run.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.sources import fs, lake
from monthlake.streaming.ingest import OUTCOMES, stream_name

FILE_BYTES = 128 << 20
FOLDED = "folded-"


def _markers(table: str) -> str:
    return f"{table}/_folds"


def markers(spark: SparkSession, table: str) -> dict[str, dict]:
    """Every committed fold: its day, and the directories still to be passed over."""
    names = fs.child_files(spark, _markers(table))
    done = {n.removesuffix(".done") for n in names if n.endswith(".done")}
    found = {n.removesuffix(".json"): n for n in names if n.endswith(".json")}
    found |= {n: f"{n}.done" for n in done}
    return {n: json.loads(fs.read_text(spark, f"{_markers(table)}/{file}")) for n, file in found.items()}


def visible(spark: SparkSession, table: str, outcome: str) -> Column:
    """Which directories of an outcome hold its rows: folds with a marker, and what no marker replaces.

    A condition on directory columns alone, so the others are not opened.
    """
    committed = markers(spark, table)
    of = F.col("stream").cast("string")
    shown = ~of.startswith(FOLDED) | of.isin(list(committed))
    for m in committed.values():
        for stream, batches in m["replaces"].get(outcome, {}).items():
            hidden = (
                (F.col("publish_date") == F.lit(m["day"]).cast("date"))
                & (of == stream)
                & F.col("batch_id").cast("long").isin(batches)
            )
            shown = shown & ~hidden
    return shown


def _committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The newest batch a stream has committed; -1 for none."""
    return max((int(n) for n in fs.child_files(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)


def recover(spark: SparkSession, table: str) -> None:
    """Finish what a run that died has left: delete replaced directories, and folds without a marker."""
    for name, m in markers(spark, table).items():
        _retire(spark, table, name, m)
    committed, present = set(markers(spark, table)), set()
    for outcome in OUTCOMES:
        for day in fs.child_dirs(spark, f"{table}/outcome={outcome}"):
            for stream in fs.child_dirs(spark, f"{table}/outcome={outcome}/{day}"):
                name = stream.removeprefix("stream=")
                present.add(name)
                if name.startswith(FOLDED) and name not in committed:
                    fs.delete(spark, f"{table}/outcome={outcome}/{day}/{stream}")
    for name in committed - present:  # folded again, or expired
        fs.delete(spark, f"{_markers(table)}/{name}.done")


def _retire(spark: SparkSession, table: str, name: str, marker: dict) -> None:
    for outcome, streams in marker["replaces"].items():
        for stream, batches in streams.items():
            path = f"{table}/outcome={outcome}/publish_date={marker['day']}/stream={stream}"
            for b in batches:
                fs.delete(spark, f"{path}/batch_id={b}")
            if not fs.child_dirs(spark, path):
                fs.delete(spark, path)
    if marker["replaces"]:
        fs.write_text(spark, f"{_markers(table)}/{name}.done", json.dumps({"day": marker["day"], "replaces": {}}))
    fs.delete(spark, f"{_markers(table)}/{name}.json")


def compact(
    spark: SparkSession, table: str, day: date, checkpoint: str, file_bytes: int = FILE_BYTES
) -> str | None:
    """Fold the committed batches of the checkpoint's stream, and earlier folds, of one day.

    Returns the fold's name; None when no outcome has two directories to fold.
    """
    recover(spark, table)
    own, newest = stream_name(spark, checkpoint), _committed_batch(spark, checkpoint)
    replaces: dict[str, dict[str, list[int]]] = {}
    for outcome in OUTCOMES:
        base = f"{table}/outcome={outcome}/publish_date={day.isoformat()}"
        for stream in fs.child_dirs(spark, base):
            name = stream.removeprefix("stream=")
            if name != own and not name.startswith(FOLDED):
                continue
            batches = [int(b.removeprefix("batch_id=")) for b in fs.child_dirs(spark, f"{base}/{stream}")]
            batches = [b for b in batches if name != own or b <= newest]
            if batches:
                replaces.setdefault(outcome, {})[name] = sorted(batches)
    replaces = {o: streams for o, streams in replaces.items() if sum(map(len, streams.values())) > 1}
    if not replaces:
        return None
    name = f"{FOLDED}{uuid.uuid4().hex[:12]}"
    for outcome, streams in replaces.items():
        base = f"{table}/outcome={outcome}/publish_date={day.isoformat()}"
        paths = [f"{base}/stream={s}/batch_id={b}" for s, batches in streams.items() for b in batches]
        size = sum(fs.size(spark, p) for p in paths)
        # A scan already packs small files into partitions of about this size: no shuffle.
        rows = spark.read.parquet(*paths).coalesce(max(1, -(-size // file_bytes)))
        rows.write.mode("overwrite").parquet(f"{base}/stream={name}/batch_id=0")
    fs.write_text(
        spark, f"{_markers(table)}/{name}.json", json.dumps({"day": day.isoformat(), "replaces": replaces})
    )
    recover(spark, table)
    return name


def days(spark: SparkSession, table: str) -> list[date]:
    """Days that hold deliveries, from directory names."""
    found = {
        n.removeprefix("publish_date=")
        for outcome in OUTCOMES
        for n in fs.child_dirs(spark, f"{table}/outcome={outcome}")
    }
    return sorted(date.fromisoformat(d) for d in found if d != "__HIVE_DEFAULT_PARTITION__")


def expire(spark: SparkSession, table: str, as_of: date, keep_days: int = 90) -> list[str]:
    """Drop the days older than `keep_days` of every outcome, and their markers; returns the days."""
    recover(spark, table)
    gone = {
        day
        for outcome in OUTCOMES
        for day in lake.expire_days(spark, f"{table}/outcome={outcome}", as_of, keep_days)
    }
    recover(spark, table)
    return sorted(gone)


def data_folders(df: DataFrame) -> DataFrame:
    """publish_date and how many batch or fold directories its rows come from; a fold is one, of as many files as its size calls for."""
    folder = F.regexp_replace(F.input_file_name(), r"/[^/]+$", "")
    named = df.select("publish_date", folder.alias("_folder")).distinct()
    return named.groupBy("publish_date").agg(F.count(F.lit(1)).alias("folders"))


def data_files(df: DataFrame) -> DataFrame:
    """publish_date and how many files its rows come from."""
    named = df.select("publish_date", F.input_file_name().alias("_file")).distinct()
    return named.groupBy("publish_date").agg(F.count(F.lit(1)).alias("files"))
