"""Connected components of links, by alternating star contractions over DataFrames.

Each round replaces links by links to smaller ids (large stars, then small stars) until every node
links to the smallest id it can reach. Rounds are written to the shared folder, so the lineage
stays short and a lost executor repeats one round at most. Nothing is collected but two numbers a
round. The centre of a large group is the smallest id of many links: its minimum combines on the
map side and is written before it is joined. So both sides of the join are plain scans, and
adaptive execution can split a centre with many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.session import shared_folder

MAX_ROUNDS = 60


def _saved(df: DataFrame, what: str) -> DataFrame:
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """`links`: a, b (ids; direction and repeats do not matter). Returns id, component: one row for
    each id that links to another, with the smallest id it reaches. No links: no rows."""
    links = _saved(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = _state(links)
    for _ in range(MAX_ROUNDS):
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _saved(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
        large = (
            both.join(least, "a").filter((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = _saved(large, "links")
        least = _saved(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.explode(F.array("b", "a")).alias("a"), F.col("m").alias("b"))
        links = _saved(small.filter(F.col("a") != F.col("b")).distinct(), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def local_forest(n: int, a, b):
    """Labels of n nodes after joining pairs (a[i], b[i]): the smallest node each reaches."""
    import numpy as np

    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
