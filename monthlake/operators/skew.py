"""Hot keys: finding them by counting a sample, and group operators no hot key can break."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthlake.plans.joins import dimension
from monthlake.session import shared_folder

SLOTS_HEX = 4  # hex digits of an MD5 used as slot: 65,536 slots, so no slot window can grow hot


SAMPLE_HITS = 200  # sampled rows expected of a key that has just min_rows


@dataclass(frozen=True)
class HotPolicy:
    """A key is hot when it holds more than `min_rows` rows, however many rows there are in all.

    Keys are counted on a sample that gives such a key SAMPLE_HITS rows, and taken from three
    quarters of that on; with min_rows up to SAMPLE_HITS every row is counted, and the test is exact.
    """

    min_rows: int = 2_000_000


DEFAULT_POLICY = HotPolicy()


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], policy: HotPolicy = DEFAULT_POLICY) -> DataFrame:
    """_hot: hashes of the hot keys, written once, so that both routes see the same ones.

    A grouped count over the sample: it combines on the map side, no task and no driver holds all
    keys, and there is no bound on how many are found.
    """
    share = min(1.0, SAMPLE_HITS / policy.min_rows)
    rows = df.select(key_hash(keys).alias("_hot"))
    rows = rows.sample(share, seed=17) if share < 1 else rows
    least = policy.min_rows if share == 1.0 else 0.75 * SAMPLE_HITS
    path = shared_folder(df.sparkSession, "hot")
    rows.groupBy("_hot").count().filter(F.col("count") > least).select("_hot").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, and rows of hot ones."""
    side = dimension(hot)
    same = key_hash(keys) == F.col("_hot")
    return df.join(side, same, "left_anti"), df.join(side, same, "left_semi")


def slot_of(fingerprint: str | Column) -> Column:
    """Slot of a row from an MD5 text: even, and in the order of the text."""
    return F.coalesce(F.substring(fingerprint, 1, SLOTS_HEX), F.lit(""))


def group_total(
    df: DataFrame, key: str, slot: str, value: Column, name: str, at_least: int = 2
) -> DataFrame:
    """sum(value) over (partition by key) for groups of any size, where it is >= at_least, else NULL.

    Totals come from map-side combined counts per (key, slot); they are read back on (key, slot),
    so a hot key is spread over all its slots. Small totals are dropped before they are read back:
    usually almost all, which leaves a side the planner can broadcast once it has seen its size.
    `key` and `slot` are never NULL (use a struct for several columns: NULLs inside it compare
    equal, as in a window).
    """
    per_slot = df.groupBy(key, slot).agg(F.sum(value).alias("_part"))
    totals = per_slot.select(
        key, slot, F.sum("_part").over(Window.partitionBy(key)).alias(name)
    ).filter(F.col(name) >= at_least)
    return df.join(totals, [key, slot], "left")


def repeat_rows(df: DataFrame, times: str, spread_by: str, chunk: int = 100_000) -> DataFrame:
    """Each row `times` times. Long runs are cut in chunks that go to different tasks."""
    chunks = F.floor((F.col(times) - 1) / chunk).cast("long")
    cut = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks)))
    # A stated number: adaptive execution would merge these small partitions before they grow.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = cut.repartition(tasks, F.col(spread_by), F.col("_chunk"))
    left = F.least(F.lit(chunk).cast("long"), F.col(times) - F.col("_chunk") * chunk)
    return spread.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), left))
    ).drop("_chunk", "_copy", times)
