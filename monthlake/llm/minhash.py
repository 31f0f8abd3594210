"""MinHash near-dedup with sequential Bayesian verification.

Documents with equal shingle sets form a class, and one of each class goes on. Signatures are cut
into bands; documents that agree in a band are candidates. A candidate pair is compared batch by
batch of its signature: with m of n hashes equal, the chance that the similarity reaches the
threshold follows from a uniform prior, and the pair is dropped once that chance is below `MISS`.
Survivors are verified on their full sets, so no wrong link remains.

Groups of copies: in each bucket of a band, documents are first compared with the smallest id only
(a row per member). Only buckets whose members are then still in different components go on: small
ones as pairs across components; in large ones the members outside the main component meet all
others in tiles of bounded size, which return a spanning forest. So a bucket of n near copies costs
about n rows, no bucket is skipped, and none is held in one task. A bucket of n unlike texts costs some
n * n / TILE rows. Misses: a pair at the threshold agrees in no band with chance (1 - 0.8^4)^32 = 5e-8,
and is dropped by a batch with chance of about 1e-4 at most.

Defined cases: null text, or text without words, has no shingles and links with nothing; a row with
null doc_id links with nothing, has a null component and is not kept; rows that repeat a doc_id are
judged each by its own text; extra columns are dropped; an empty table gives an empty result.
Words and shingles are compared by 64-bit hashes, equal sets by 128-bit ones.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthlake.llm import text as tx
from monthlake.llm.components import components
from monthlake.llm.packing import _chunks
from monthlake.plans.joins import dimension
from monthlake.session import shared_folder

HASHES, BAND_ROWS = 128, 4
BANDS = HASHES // BAND_ROWS
BATCH = 32  # hashes compared between two decisions
MISS = 1e-5
SHARE = 80  # percent of the union that has to be common
SMALL_BUCKET = 48
TILE = 512
BROADCAST_IDS = 500_000

_rng = np.random.default_rng(20240229)  # fixed: signatures have to agree between runs
_MUL = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_STEP = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; fewer words make one shingle."""
    lower = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(lower)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    code = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    filled = np.fromiter((w != "" for w in words), bool, len(words))
    index = coded.indices.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        at = index[a:b]
        h = code[at[filled[at]]]
        n = max(1, len(h) - k + 1)
        width = min(k, len(h))
        if not width:
            out.append(np.empty(0, np.uint64))
            continue
        total = np.full(n, np.uint64(width))
        for j in range(width):
            total += _mixed(h[j : j + n] + np.uint64(j)) * _STEP[j % 64]
        out.append(np.unique(_mixed(total)))
    return out


def signature(shingles: np.ndarray) -> bytes:
    low = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(shingles), 1024):
        part = shingles[at : at + 1024]
        h = ((part[None, :] ^ _XOR[:, None]) * _MUL[:, None]) >> np.uint64(32)
        np.minimum(low, h.min(axis=1).astype(np.uint32), out=low)
    return low.tobytes()


def _set_key(shingles: bytes) -> bytes | None:
    """The key of a set; equal for equal sets, null for the empty one."""
    return hashlib.blake2b(shingles, digest_size=16).digest() if shingles else None


def _fields(docs: DataFrame, *more: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [T.StructField(*m) for m in more])


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, key (of the set; null if empty), sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (c for b in batches for c in _chunks(b)):
            sets = shingle_sets(batch["text"], k)
            keys = [_set_key(s.tobytes()) for s in sets]
            known: dict[bytes, bytes] = {}
            for key, s in zip(keys, sets, strict=True):
                if key and key not in known:
                    known[key] = signature(s)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array([known[x] if x else None for x in keys], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "key", "sig"],
            )

    schema = _fields(docs, ("n_shingles", T.LongType()), ("key", T.BinaryType()), ("sig", T.BinaryType()))
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """id and shingles (sorted 64-bit hashes) of the classes in `ids`, each once.

    The text of a class is found by the doc_id of one of its rows, and then by its key, since other
    texts may have that doc_id too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (c for b in batches for c in _chunks(b)):
            sets = [s.tobytes() for s in shingle_sets(batch["text"], k)]
            keys = pa.array([_set_key(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, pa.array(sets, pa.binary())], names=["key", "shingles"])

    wanted = _saved(classes.join(ids, "id", "left_semi").select("id", "key", "least"), "wanted")
    texts = docs.select("doc_id", "text").join(
        dimension(wanted.select(F.col("least").alias("doc_id")).distinct(), BROADCAST_IDS), "doc_id", "left_semi"
    )
    made = texts.mapInArrow(run, "key binary, shingles binary").groupBy("key").agg(F.any_value("shingles").alias("shingles"))
    return made.join(wanted.select("key", "id"), "key").select("id", "shingles")


@lru_cache(maxsize=8)
def least_matches(share: int = SHARE, miss: float = MISS) -> dict[int, int]:
    """For n hashes compared, the fewest matches m with P(similarity >= share | m of n) >= miss.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), and its upper tail at t equals
    P(Binomial(n + 1, t) <= m).
    """
    t, out = share / 100, {}
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out[n] = m
    return out


def plausible(a: np.ndarray, b: np.ndarray, share: int = SHARE, miss: float = MISS) -> np.ndarray:
    """Which rows of the signature matrices a and b stay after all batches."""
    need = least_matches(share, miss)
    rows, hits = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n in sorted(need):
        s = slice(n - BATCH, n)
        hits = hits + (a[rows, s] == b[rows, s]).sum(axis=1)
        ok = hits >= need[n]
        rows, hits = rows[ok], hits[ok]
    return rows


def similar(a: np.ndarray, b: np.ndarray, share: int = SHARE) -> bool:
    if min(len(a), len(b)) * 100 < share * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= share * (len(a) + len(b) - both)


def _saved(df: DataFrame, what: str) -> DataFrame:
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _sigs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, HASHES)


def prune(pairs: DataFrame, sigs: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b) that stay plausible."""
    with_sigs = pairs.join(sigs.toDF("a", "sa"), "a").join(sigs.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield f[["a", "b"]].iloc[plausible(_sigs(f["sa"]), _sigs(f["sb"]), share)]

    return with_sigs.mapInPandas(run, pairs.select("a", "b").schema)


def verify(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the share."""
    both = pairs.join(sets.toDF("a", "xa"), "a").join(sets.toDF("b", "xb"), "b").select("a", "b", "xa", "xb")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = [
                similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), share)
                for x, y in zip(f["xa"], f["xb"], strict=True)
            ]
            yield f.loc[ok, ["a", "b"]]

    return both.mapInPandas(run, pairs.select("a", "b").schema)


def _checked(docs, classes: DataFrame, pairs: DataFrame, sigs: DataFrame, k: int, share: int) -> DataFrame:
    left = _saved(prune(pairs, sigs, share), "pairs")
    ids = left.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = _saved(full_sets(docs, classes, _saved(ids, "ids"), k), "sets")
    return _saved(verify(left, sets, share), "links")


def _tiled_links(docs, classes: DataFrame, residual: DataFrame, sigs: DataFrame, k: int, share: int) -> DataFrame:
    """Links across components in large buckets, in groups of bounded size.

    Most members of a bucket are in its main component and need no comparison with each other. So
    main members are dealt to tiles once for each tile of outsiders (mostly one), and only outsiders
    meet every tile.
    """
    ids = _saved(residual.select("id").distinct(), "ids")
    sets = _saved(full_sets(docs, classes, ids, k), "sets")
    outside = F.col("component") != F.col("main")
    main_tiles = F.greatest(F.ceil((F.col("size") - F.col("outsiders")) / TILE), F.lit(1))
    out_tiles = F.ceil(F.col("outsiders") / TILE)
    spread = F.xxhash64("id")
    own = F.when(outside, F.pmod(spread, out_tiles)).otherwise(F.pmod(spread, main_tiles)).cast("long")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)
    with_main = F.transform(
        F.when(outside, upto(main_tiles)).otherwise(upto(out_tiles)),
        lambda t: F.struct(
            F.lit(True).alias("across"),
            F.when(outside, t).otherwise(F.col("tile")).alias("x"),
            F.when(outside, F.col("tile")).otherwise(t).alias("y"),
        ),
    )
    among = F.transform(
        F.when(outside, upto(out_tiles)).otherwise(F.array().cast("array<long>")),
        lambda t: F.struct(
            F.lit(False).alias("across"), F.least(t, "tile").alias("x"), F.greatest(t, "tile").alias("y")
        ),
    )
    placed = (
        residual.withColumn("outside", outside)
        .withColumn("tile", own)
        .withColumn("at", F.explode(F.concat(with_main, among)))
        .select("bucket", "at.across", "at.x", "at.y", "id", "component", "outside")
    )
    body = placed.join(sigs, "id").join(sets, "id")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["outside", "id"], ascending=[False, True], kind="stable")
        ids, comp = frame["id"].to_numpy(), pd.factorize(frame["component"])[0]
        sig, sets = _sigs(frame["sig"]), [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        outsiders, across = int(frame["outside"].sum()), bool(frame["across"].iloc[0])
        a, b = [], []
        for i in range(outsiders):
            first = outsiders if across else i + 1
            # Once joined here, two documents need no further comparison.
            j = first + np.flatnonzero(comp[first:] != comp[i])
            j = j[plausible(np.broadcast_to(sig[i], (len(j), HASHES)), sig[j], share)]
            for m in j:
                if comp[m] != comp[i] and similar(sets[i], sets[m], share):
                    a.append(ids[i]), b.append(ids[m])
                    comp[comp == comp[m]] = comp[i]
        return pd.DataFrame({"a": a, "b": b})

    groups = body.groupBy("bucket", "across", "x", "y")
    return _saved(groups.applyInPandas(run, "a long, b long").distinct(), "links")


def near_duplicates(docs: DataFrame, k: int = 5, share: int = SHARE) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept."""
    told = _saved(sketches(docs, k), "sketches")
    # A class has an id of its own (saved): a doc_id may stand in several classes.
    classes = _saved(
        told.filter(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("key")
        .agg(F.min("doc_id").alias("least"), F.any_value("sig").alias("sig"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    sigs = classes.select("id", "sig")
    bands = F.array(
        *[F.xxhash64(F.lit(i), F.substring("sig", 4 * BAND_ROWS * i + 1, 4 * BAND_ROWS)) for i in range(BANDS)]
    )
    banded = sigs.select("id", F.explode(bands).alias("bucket"))
    # Aggregates are written before they are joined to what they were made of: only then are both
    # sides of the join stages of their own, which adaptive execution can split at a hot key.
    shared = _saved(
        banded.groupBy("bucket")
        .agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("size"))
        .filter(F.col("size") > 1),
        "shared",
    )
    members = _saved(banded.join(shared, "bucket"), "members")
    stars = members.filter(F.col("id") != F.col("leader")).select(F.col("leader").alias("a"), F.col("id").alias("b"))
    stars = _saved(stars.distinct(), "stars")
    links = _checked(docs, classes, stars, sigs, k, share)
    joined = components(links)

    # Buckets of more than two whose members are still apart.
    now = members.filter(F.col("size") > 2).join(joined, "id", "left").select(
        "bucket", "size", "id", F.coalesce("component", "id").alias("component")
    )
    # The main component of each such bucket, and how many members are outside it.
    apart = _saved(
        now.groupBy("bucket", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("bucket")
        .agg(F.max("n").alias("most"), F.sum("n").alias("all"), F.max_by("component", F.struct("n", "component")).alias("main"))
        .filter(F.col("most") < F.col("all"))
        .select("bucket", "main", (F.col("all") - F.col("most")).alias("outsiders")),
        "apart",
    )
    residual = _saved(now.join(apart, "bucket"), "residual")
    small = residual.filter(F.col("size") <= SMALL_BUCKET)
    x, y = small.alias("x"), small.alias("y")
    across = (
        x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.id") < F.col("y.id"))
               & (F.col("x.component") != F.col("y.component")))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    more = _checked(docs, classes, across, sigs, k, share)
    tiled = _tiled_links(docs, classes, residual.filter(F.col("size") > SMALL_BUCKET), sigs, k, share)
    settled = joined.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(more).unionAll(tiled)
    final = components(settled)
    placed = _saved(classes.select("id", "key", "least").join(final, "id", "left"), "placed")
    least = placed.filter(F.col("component").isNotNull()).groupBy("component").agg(F.min("least").alias("component_id"))
    by_key = _saved(
        placed.join(_saved(least, "least"), "component", "left").select("key", F.coalesce("component_id", "least").alias("component_id")),
        "by-key",
    )
    return (
        told.select("doc_id", "n_shingles", "key")
        .join(by_key, "key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def op7_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(tx.documents(spark, sf_dir).select("doc_id", "text"), k=4)
