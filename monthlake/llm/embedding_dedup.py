"""Embedding near-dedup: links of cosine >= a threshold within a label, by PCA-ordered tiles.

Equal vectors of a label become one class first. Classes are rotated to principal axes and laid out
in tiles along the first; a pair of tiles is compared only where the boxes of their leading
coordinates are close enough for the threshold. Inside a pair, dot products grow by blocks of
dimensions, leading ones first: what the rest can add is bounded by the product of suffix norms, and
a pair of vectors stops as soon as the threshold is out of reach. Survivors are checked in double
precision on the vectors as given. A task returns sums and a spanning forest, never all its links,
so a group of copies yields as many rows as it has members.

The comparison of one label stays quadratic in its number of different vectors where boxes prune
little; tiles bound memory and spread the work, they do not change that.

Defined cases: a row links with nothing (n_links 0, its own component) when its label or vector is
null, empty, zero, or holds null or non-finite components; vectors of different length are not
compared. A row with null vec_id links with nothing, and its component is null and it is not kept. Rows that
repeat a vec_id count as vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monthlake.llm.components import components, local_forest
from monthlake.session import shared_folder

THRESHOLD = 0.93
TILE = 1024  # classes; a tile holds twice as many at most
BOX = 8  # leading coordinates that bound a tile
BLOCK = 8  # dimensions added at a time
BINS = 4096
SLACK = 1e-9


def _units(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _saved(df: DataFrame, what: str) -> DataFrame:
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _usable() -> F.Column:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & ~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda x: x != 0)
    )


def _with_digest(rows: DataFrame) -> DataFrame:
    @F.pandas_udf("binary")
    def digest(vectors: pd.Series) -> pd.Series:
        return vectors.map(lambda v: hashlib.blake2b((np.asarray(v) + 0.0).tobytes(), digest_size=16).digest())

    return rows.withColumn("key", digest("embedding"))


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length, the axes (columns, largest spread first) of all unit vectors."""

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                x = _units(part["embedding"])
                sums[dim] = sums.get(dim, 0) + x.T @ x
        for dim, s in sums.items():
            yield pd.DataFrame({"dim": [dim], "s": [s.ravel()]})

    parts = classes.select("dim", "embedding").mapInPandas(moments, "dim int, s array<double>")
    # Summed by place: dim x dim numbers a vector length reach the driver, however many partitions.
    rows = parts.select("dim", F.posexplode("s")).groupBy("dim", "pos").agg(F.sum("col").alias("v")).toPandas()
    axes = {}
    for dim, part in rows.groupby("dim"):
        m = part.sort_values("pos")["v"].to_numpy().reshape(dim, dim)
        axes[int(dim)] = np.linalg.eigh(m)[1][:, ::-1]
    return axes


def near_pairs(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, same: bool):
    """Row pairs (i, j) of unit vectors with dot >= threshold; i < j if both sides are the same."""
    a, b = x @ axes, y @ axes
    dim = a.shape[1]
    edges = [*range(0, dim, BLOCK), dim]
    # Norm of what comes after each block.
    suffix = lambda z: np.sqrt(np.maximum(np.cumsum((z * z)[:, ::-1], axis=1)[:, ::-1], 0))
    sa, sb = suffix(a), suffix(b)
    dots = a[:, : edges[1]] @ b[:, : edges[1]].T
    rest = np.outer(sa[:, edges[1]], sb[:, edges[1]]) if dim > edges[1] else 0.0
    keep = dots + rest >= threshold - SLACK
    if same:
        keep &= np.triu(np.ones(keep.shape, dtype=bool), 1)
    i, j = np.nonzero(keep)
    partial = dots[i, j]
    for lo, hi in zip(edges[1:-1], edges[2:], strict=True):
        step = max(1, (1 << 21) // (hi - lo))
        for at in range(0, len(i), step):
            s = slice(at, at + step)
            partial[s] += np.einsum("ij,ij->i", a[i[s], lo:hi], b[j[s], lo:hi])
        rest = sa[i, hi] * sb[j, hi] if hi < dim else 0.0
        ok = partial + rest >= threshold - SLACK
        i, j, partial = i[ok], j[ok], partial[ok]
    exact = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), 1 << 15):
        s = slice(at, at + (1 << 15))
        exact[s] = np.einsum("ij,ij->i", x[i[s]], y[j[s]]) >= threshold
    return i[exact], j[exact]


def tiles(classes: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """`classes` with lead (first coordinates) and tile: runs along the first axis, within a label."""

    @F.pandas_udf("array<double>")
    def leading(vectors: pd.Series) -> pd.Series:
        out = [None] * len(vectors)
        dims = vectors.map(len)
        for dim in dims.unique():
            at = np.flatnonzero(dims == dim)
            lead = _units(vectors.iloc[at]) @ axes[int(dim)][:, :BOX]
            for k, row in zip(at, lead, strict=True):
                out[k] = row.tolist()
        return pd.Series(out, dtype=object)

    place = F.least(F.floor((F.get("lead", F.lit(0)) + 1) * (BINS // 2)), F.lit(BINS - 1)).cast("int")
    led = classes.withColumn("lead", leading("embedding")).withColumn("bin", place)
    group = ["label", "dim"]
    before = W.partitionBy(*group).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = (
        led.groupBy(*group, "bin")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_run", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / TILE))
        .withColumn("_parts", F.ceil(F.col("_n") / TILE))
    )
    large = F.col("_parts") > 1
    salt = F.when(large, F.expr("pmod(xxhash64(rep), _parts)")).otherwise(F.lit(0))
    return (
        led.join(bins, [*group, "bin"])
        .withColumn("tile", F.struct("_run", F.when(large, F.col("bin")).otherwise(-1).alias("b"), salt.alias("s")))
        .drop("bin", "_n", "_run", "_parts")
    )


def tile_pairs(tiled: DataFrame, threshold: float) -> DataFrame:
    """Pairs of tiles of a label (a tile with itself too) whose boxes allow the threshold."""
    lead = lambda k: F.get("lead", F.lit(k))
    boxes = tiled.groupBy("label", "dim", "tile").agg(
        F.array(*[F.min(lead(k)) for k in range(BOX)]).alias("lo"),
        F.array(*[F.max(lead(k)) for k in range(BOX)]).alias("hi"),
    )
    a, b = boxes.alias("a"), boxes.alias("b")
    gap = lambda k: F.greatest(
        F.lit(0.0),
        F.coalesce(F.get("a.lo", F.lit(k)) - F.get("b.hi", F.lit(k)), F.lit(0.0)),
        F.coalesce(F.get("b.lo", F.lit(k)) - F.get("a.hi", F.lit(k)), F.lit(0.0)),
    )
    distance = sum((gap(k) * gap(k) for k in range(BOX)), F.lit(0.0))
    same_group = (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim"))
    pairs = a.join(b, same_group & (F.col("a.tile") <= F.col("b.tile")))
    pairs = pairs.filter(distance <= 2 - 2 * threshold + SLACK)
    return pairs.select(
        F.col("a.label").alias("label"), F.col("a.dim").alias("dim"), F.col("a.tile").alias("ta"), F.col("b.tile").alias("tb")
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    rows = _saved(
        _with_digest(vectors.filter(_usable()).select("vec_id", "label", "embedding"))
        .withColumn("dim", F.size("embedding")),
        "vectors",
    )
    # A class has an id of its own (saved): a vec_id may stand in several classes.
    classes = _saved(
        rows.groupBy("label", "dim", "key")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.any_value("embedding").alias("embedding"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "classes",
    )
    axes = principal_axes(classes)
    tiled = _saved(tiles(classes.drop("key", "least"), axes), "tiles")
    pairs = _saved(tile_pairs(tiled, threshold), "tile-pairs")
    body = tiled.select("label", "dim", "tile", "rep", "n", "embedding")
    sides = pairs.select("*", F.explode(F.array_distinct(F.array("ta", "tb"))).alias("tile"))
    work = body.join(sides, ["label", "dim", "tile"]).withColumn("first", F.col("tile") == F.col("ta"))

    def compare(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rep", kind="stable")
        dim, same = int(key[1]), bool(frame["first"].all())
        x = _units(frame["embedding"])
        left = np.flatnonzero(frame["first"].to_numpy())
        right = left if same else np.flatnonzero(~frame["first"].to_numpy())
        i, j = near_pairs(x[left], x[right], axes[dim], threshold, same)
        i, j = left[i], right[j]
        n = frame["n"].to_numpy()
        links = np.zeros(len(frame), dtype=np.int64)
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        root = local_forest(len(frame), i, j)
        rep, hit = frame["rep"].to_numpy(), links > 0
        return pd.DataFrame({"rep": rep[hit], "links": links[hit], "root": rep[root[hit]]})

    found = _saved(
        work.select("label", "dim", "ta", "tb", "rep", "n", "first", "embedding")
        .groupBy("label", "dim", "ta", "tb")
        .applyInPandas(compare, "rep long, links long, root long"),
        "found",
    )
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("rep").agg(F.sum("links").alias("_links"))
    members = joined.withColumnRenamed("id", "rep").join(classes.select("rep", "least"), "rep")
    # Written before they are joined, so that adaptive execution can split a large component or class.
    named = _saved(members.groupBy("component").agg(F.min("least").alias("component_id")), "named")
    told = _saved(
        classes.select("label", "dim", "key", "rep", "least", "n")
        .join(sums, "rep", "left")
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        .join(named, "component", "left")
        .select("label", "dim", "key", (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component_id", "least").alias("component_id")),
        "told",
    )
    linked = rows.select("vec_id", "label", "dim", "key").join(told, ["label", "dim", "key"])
    alone = vectors.filter(~F.coalesce(_usable(), F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.select("vec_id", "n_links", "component_id").unionAll(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def op5_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
