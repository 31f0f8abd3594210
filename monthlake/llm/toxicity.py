"""Toxicity: class-conditional Kneser-Ney models of words, compared by length-normalised likelihoods.

A word is spelled byte by byte, and each class (toxic, ordinary) has an n-gram model of its bytes up to
`ORDER`, so that unseen forms of a known expression count too. Both are Kneser-Ney models:

- Counts are continuation counts: a word counts once for each different word before it, not once
  for each time it occurs, so lines or documents that repeat weigh no more than one.
- Absolute discounting, interpolated: P(x | g) = max(n(gx)/n(g) - d, 0) + rest(g) P(x | shorter g). The discount d
  is shared by both classes: `SIGMA` standard errors that the pooled share of gx would have in the
  smaller class. What is rarer than that keeps no count of its own and rests on the backoff.
- The backoff ends in the byte counts of both classes together, so rare expressions cost both alike.

A toxic text takes each word from the toxic model with chance `SHARE`, else from the ordinary one; an
ordinary text takes all from the ordinary model. The difference of both log-likelihoods over the number of
words is turned into a score by a logistic curve, fitted on rows that gave no counts.

Counts come from folds 1 to 3 of crc32(doc_id as text) mod 5, the curve from fold 4, all labelled rows of each; fold 0
is held out. Counting is grouped by Spark: (word, word before) pairs first, then words, then n-grams. All
n-grams beyond the discount belong to the model. Up to `MODEL_ROWS` of them reach the driver and the workers, and scoring is
one Arrow pass over whole texts, without shuffle. A larger model stays a table: the different words of the texts are
joined with it by n-gram, and their log ratios with the words of each text. Both ways give the same differences, but
for the rounding of sums.

Defined cases: null and empty text, or text without a word, has difference 0 and the score of that; labels
that are null or not 0/1 are ignored, of several labels of a document the largest counts; without rows of both
classes to count, all differences are 0; without rows of both classes for the curve, the score is the
smoothed share of toxic rows there (a quarter without rows). Repeated rows are scored alike. Extra columns are dropped; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monthlake.llm import text as tx
from monthlake.llm.packing import _chunks
from monthlake.llm.vector_codes import _saved
from monthlake.plans.joins import dimension

ORDER = 8  # bytes of the longest n-gram; it fits one 64-bit key
SIGMA = 4.0
MODEL_ROWS = 1 << 21  # n-grams of a model that workers hold, some 36 bytes each
SHARE = 0.003
MOST = 30.0  # of a word's log ratio; beyond that a word is toxic anyway
HELD_OUT, CURVE, FOLDS = 0, 4, 5
LABELS_BROADCAST = 500_000
BLOCK = 1 << 20  # byte places handled at a time
FLOOR, BIN = 1e-4, 0.02  # of the difference, for the curve's histogram
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def coded_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different words, the words of all texts as numbers, and where each text ends."""
    lower = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, _GAPS, " "))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    index = coded.indices.to_numpy(zero_copy_only=False)
    filled = np.fromiter((bool(w) for w in words), bool, len(words))
    ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
    if filled.all():
        return words, index, ends
    keep = filled[index]
    ends = np.concatenate([[0], np.cumsum(keep)])[ends]
    renumbered = np.cumsum(filled) - 1
    return [w for w in words if w], renumbered[index[keep]], ends


def pairs(labelled: DataFrame) -> DataFrame:
    """Different (word, hash of the word before) with the classes that hold them, as bits; `labelled`: text, toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (c for b in batches for c in _chunks(b)):
            words, index, ends = coded_words(batch["text"])
            if not len(index):
                continue
            size = np.diff(np.concatenate([[0], ends]))
            bit = np.repeat(1 << batch["toxic"].to_numpy(zero_copy_only=False).astype(np.int64), size)
            before = np.concatenate([[-1], index[:-1]]).astype(np.int64)
            before[np.concatenate([[0], ends[:-1]])[size > 0]] = -1  # a text's first word
            key = np.unique(((index * np.int64(len(words) + 1) + before + 1) << 2) | bit)
            pair, bits = key >> 2, key & 3
            hashes = np.array([0, *(xxhash.xxh3_64_intdigest(w) for w in words)], np.uint64).view(np.int64)
            word = pa.array(words, pa.binary()).take(pa.array(pair // (len(words) + 1)))
            yield pa.RecordBatch.from_arrays(
                [word, pa.array(hashes[pair % (len(words) + 1)]), pa.array(bits.astype(np.int32))], names=["word", "before", "bits"]
            )

    return labelled.select("text", "toxic").mapInArrow(run, "word binary, before long, bits int")


def vocabulary(labelled: DataFrame) -> DataFrame:
    """word with the number of different words before it in ordinary (m0) and toxic (m1) texts."""
    different = pairs(labelled).groupBy("word", "before").agg(F.bit_or("bits").alias("bits"))
    counts = [F.count_if(F.col("bits").bitwiseAND(1 << y) != 0).alias(f"m{y}") for y in (0, 1)]
    return different.groupBy("word").agg(*counts)


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All words between blanks, one after the other, and where each begins in that."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return np.frombuffer(b" " + b"  ".join(words) + b" " if words else b"", np.uint8), np.cumsum(sizes) - sizes


def gram_keys(data: np.ndarray, depth: np.ndarray, at: int, to: int, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length up to `order`: places (from `at`) that have such an n-gram in their word, its key, and
    the key of its first bytes. `depth`: bytes of the word before a place."""
    size = to - at
    behind = np.zeros(size, np.uint64)
    for k in range(order):
        ok = np.flatnonzero((depth[at:to] >= k) & (depth[at:to] > 0))
        if not len(ok):
            return
        if k:
            behind[ok] |= data[ok + at - k].astype(np.uint64) << np.uint64(8 * (k - 1))
        yield ok, (behind[ok] << np.uint64(8)) | data[ok + at], behind[ok]


def _depths(starts: np.ndarray, size: int) -> np.ndarray:
    owner = np.zeros(size, np.int64)
    owner[starts[1:]] = 1
    return np.arange(size) - starts[np.cumsum(owner)] if size else owner


def gram_counts(words: DataFrame, order: int = ORDER) -> DataFrame:
    """key, first (key of its first bytes), size, c0, c1: pooled over all words (m0, m1 each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = spelled(batch["word"].to_pylist())
            depth = _depths(starts, len(data))
            m = [batch[f"m{y}"].to_numpy(zero_copy_only=False) for y in (0, 1)]
            for at in range(0, len(data), BLOCK):
                to = min(at + BLOCK, len(data))
                word = np.searchsorted(starts, np.arange(at, to), "right") - 1
                for k, (ok, key, first) in enumerate(gram_keys(data, depth, at, to, order)):
                    key, one, inverse = np.unique(key, return_index=True, return_inverse=True)
                    counts = [np.bincount(inverse, weights=c[word[ok]]).astype(np.int64) for c in m]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(first[one].view(np.int64)),
                         pa.array(np.full(len(key), k + 1, np.int32)), *map(pa.array, counts)],
                        names=["key", "first", "size", "c0", "c1"],
                    )

    found = words.mapInArrow(run, "key long, first long, size int, c0 long, c1 long")
    return found.groupBy("key", "first", "size").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


@dataclass(frozen=True)
class Model:
    """Kept n-grams: key, what each class has beyond the discount; and what each class leaves to the
    backoff after some first bytes."""

    keys: np.ndarray
    over: np.ndarray  # 2 x keys
    firsts: np.ndarray
    rest: np.ndarray  # 2 x firsts
    base: np.ndarray  # pooled shares of single bytes
    order: int = ORDER


@dataclass(frozen=True)
class Tables:
    """The same model, too large for a worker: `over` (key, v0, v1) and `rest` (first, r0, r1) as saved tables."""

    over: DataFrame
    rest: DataFrame
    base: np.ndarray
    order: int = ORDER


def build(grams: DataFrame, order: int = ORDER, sigma: float = SIGMA, most: int = MODEL_ROWS) -> Model | Tables:
    """The model of saved n-gram counts; tables if it has more than `most` n-grams."""
    # At most 256 n-grams share their first bytes, so a window is bounded.
    same = W.partitionBy("first", "size")
    n0, n1 = F.sum("c0").over(same), F.sum("c1").over(same)
    counted = grams.withColumns({"n0": n0, "n1": n1})
    pooled = (F.col("c0") + F.col("c1")) / (F.col("n0") + F.col("n1"))
    smaller = F.least("n0", "n1")
    discount = F.lit(sigma) * F.sqrt(pooled / smaller)
    over = [F.when(smaller > 0, F.greatest(F.col(f"c{y}") / F.col(f"n{y}") - discount, F.lit(0.0))).otherwise(F.lit(0.0)) for y in (0, 1)]
    judged = counted.withColumns({"v0": over[0], "v1": over[1]})
    found = _saved(judged.filter((F.col("v0") > 0) | (F.col("v1") > 0)).select("key", "first", "v0", "v1"), "model")
    single = grams.filter("size = 1").select("key", (F.col("c0") + F.col("c1")).alias("c")).toPandas()  # at most 256 rows
    base = np.ones(256)
    base[single["key"].to_numpy(np.int64)] += single["c"].to_numpy(float)
    base = base / base.sum()
    if found.count() > most:
        rest = found.groupBy("first").agg(*[(1 - F.sum(f"v{y}")).alias(f"r{y}") for y in (0, 1)])
        return Tables(found.select("key", "v0", "v1"), _saved(rest, "rest"), base, order)
    kept = found.toPandas().sort_values("key", kind="stable")  # at most `most` rows
    by_first = kept.sort_values(["first", "key"], kind="stable").groupby("first")[["v0", "v1"]].sum()
    keys, firsts = kept["key"].to_numpy(np.int64).view(np.uint64), by_first.index.to_numpy(np.int64).view(np.uint64)
    a, b = np.argsort(keys), np.argsort(firsts)
    over_rows = kept[["v0", "v1"]].to_numpy(float).T[:, a]
    return Model(keys[a], over_rows, firsts[b], 1 - by_first.to_numpy(float).T[:, b], base, order)


def _looked_up(wanted: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of `wanted` are among the sorted `keys`, and where."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def word_ratios(words: list[bytes], model: Model) -> np.ndarray:
    """log(P toxic / P ordinary) of each word, all its bytes and its end included."""
    data, starts = spelled(words)
    depth = _depths(starts, len(data))
    ratio = np.zeros(len(data))
    for at in range(0, len(data), BLOCK):
        to = min(at + BLOCK, len(data))
        p = np.tile(model.base[data[at:to]], (2, 1))
        for ok, key, first in gram_keys(data, depth, at, to, model.order):
            hit, place = _looked_up(first, model.firsts)
            if not hit.any():
                continue
            # Without a known beginning there is neither a count nor a discount.
            ok, key, place = ok[hit], key[hit], place[hit]
            now = p[:, ok] * model.rest[:, place]
            known, place = _looked_up(key, model.keys)
            now[:, known] += model.over[:, place[known]]
            p[:, ok] = now
        ratio[at:to] = np.log(p[1] / p[0])
    return np.add.reduceat(ratio, starts) if len(words) else np.zeros(0)


def differences(texts: pa.Array, model: Model, share: float = SHARE) -> np.ndarray:
    """Log-likelihood as a toxic text less that as an ordinary one, over the number of words."""
    words, index, ends = coded_words(texts)
    each = np.log1p(share * np.expm1(np.minimum(word_ratios(words, model), MOST)))
    upto = np.concatenate([[0.0], np.cumsum(each[index])])
    begins = np.concatenate([[0], ends[:-1]])
    total = np.array([each[index[a:b]].sum() for a, b in zip(begins, ends, strict=True)]) if len(upto) > 1 else np.zeros(len(ends))
    return total / np.maximum(ends - begins, 1)


def _id(word: bytes) -> bytes:
    return xxhash.xxh3_128_digest(word)


def occurrences(docs: DataFrame) -> DataFrame:
    """text_key (MD5), word (its hash), times: the different words of each row's text; `docs`: text_key, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (c for b in batches for c in _chunks(b)):
            words, index, ends = coded_words(batch["text"])
            row = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
            pair, times = np.unique(row * np.int64(len(words) + 1) + index, return_counts=True)
            word = pa.array([_id(w) for w in words], pa.binary()).take(pa.array(pair % (len(words) + 1)))
            yield pa.RecordBatch.from_arrays(
                [batch["text_key"].take(pa.array(pair // (len(words) + 1))), word, pa.array(times.astype(np.int64))],
                names=["text_key", "word", "times"],
            )

    return docs.select("text_key", "text").mapInArrow(run, "text_key string, word binary, times long")


def places(texts: DataFrame, base: np.ndarray, order: int = ORDER) -> DataFrame:
    """word (its hash), place, size, key, first, base: each n-gram of each different word of `texts` (text)."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (c for b in batches for c in _chunks(b)):
            yield pa.RecordBatch.from_arrays([pa.array(coded_words(batch["text"])[0], pa.binary())], names=["word"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch["word"].to_pylist()
            data, starts = spelled(words)
            depth = _depths(starts, len(data))
            ids = pa.array([_id(w) for w in words], pa.binary())
            for at in range(0, len(data), BLOCK):
                to = min(at + BLOCK, len(data))
                owner = np.searchsorted(starts, np.arange(at, to), "right") - 1
                for k, (ok, key, first) in enumerate(gram_keys(data, depth, at, to, order)):
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(owner[ok])), pa.array(depth[ok + at]), pa.array(np.full(len(ok), k + 1, np.int32)),
                         pa.array(key.view(np.int64)), pa.array(first.view(np.int64)), pa.array(base[data[ok + at]])],
                        names=["word", "place", "size", "key", "first", "base"],
                    )

    words = texts.select("text").mapInArrow(listed, "word binary").distinct()
    return words.mapInArrow(run, "word binary, place long, size int, key long, first long, base double")


def joined_ratios(texts: DataFrame, model: Tables) -> DataFrame:
    """word (its hash), ratio: as `word_ratios`, of all different words of `texts` (text), by joins with the model."""
    # Without a known beginning there is neither a count nor a discount.
    known = places(texts, model.base, model.order).join(model.rest, "first", "left").join(model.over, "key", "left")
    amounts = {c: F.coalesce(c, F.lit(none)).alias(c) for c, none in (("r0", 1.0), ("r1", 1.0), ("v0", 0.0), ("v1", 0.0))}
    steps = known.select("word", "place", "base", F.struct("size", *amounts.values()).alias("step"))
    # `order` steps at most, from the shortest n-gram to the longest.
    one = steps.groupBy("word", "place").agg(F.first("base").alias("base"), F.sort_array(F.collect_list("step")).alias("steps"))
    ordinary = F.aggregate("steps", F.col("base"), lambda p, s: s["v0"] + s["r0"] * p)
    toxic = F.aggregate("steps", F.col("base"), lambda p, s: s["v1"] + s["r1"] * p)
    return one.select("word", F.log(toxic / ordinary).alias("ratio")).groupBy("word").agg(F.sum("ratio").alias("ratio"))


def _joined_difference(docs: DataFrame, model: Tables, text: str, share: float = SHARE) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.md5(body).alias("text_key"), body.alias("text"))
    ratios = _saved(joined_ratios(texts, model), "ratios")
    each = F.log1p(F.lit(share) * F.expm1(F.least("ratio", F.lit(MOST))))
    # Copies of a text raise both sums alike.
    sums = occurrences(texts).join(ratios, "word").groupBy("text_key").agg((F.sum(F.col("times") * each) / F.sum("times")).alias("_found"))
    keyed = docs.withColumn("_text_key", F.md5(body)).join(_saved(sums, "differences").withColumnRenamed("text_key", "_text_key"), "_text_key", "left")
    return keyed.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce("_found", F.lit(0.0)).alias("_difference"))


def with_difference(docs: DataFrame, model: Model | Tables, text: str = "text") -> DataFrame:
    """`docs` with the column _difference."""
    if isinstance(model, Tables):
        return _joined_difference(docs, model, text)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = _chunks(pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string(), from_pandas=True)], names=["text"]))
            yield pd.Series(np.concatenate([differences(p["text"], model) for p in parts]) if len(texts) else np.zeros(0))

    return docs.withColumn("_difference", run(F.col(f"`{text}`")))


def logistic(x: np.ndarray, n0: np.ndarray, n1: np.ndarray, l2: float = 1e-3) -> tuple[float, float]:
    """Intercept and slope of the logistic curve through counts n0, n1 at x, by Newton steps."""
    total, toxic = n0.sum() + n1.sum(), n1.sum()
    if not toxic or toxic == total:
        return math.log((toxic + 0.5) / (total - toxic + 1.5)), 0.0
    centre = float((x * (n0 + n1)).sum() / total)
    z = np.stack([np.ones(len(x)), x - centre])
    w = np.array([math.log(toxic / (total - toxic)), 0.0])

    def loss(v):
        f = v @ z
        return (np.logaddexp(0, f) * (n0 + n1) - n1 * f).sum() + l2 / 2 * v @ v

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w @ z, -500, 500)))
        grad = z @ (p * (n0 + n1) - n1) + l2 * w
        step = np.linalg.solve((z * (p * (1 - p) * (n0 + n1))) @ z.T + l2 * np.eye(2), grad)
        t = 1.0
        while loss(w - t * step) > loss(w) and t > 1e-6:
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-10:
            break
    return float(w[0] - w[1] * centre), float(w[1])


def _stretched(difference: Column) -> Column:
    return F.log(F.greatest(difference, F.lit(0.0)) + FLOOR)


@dataclass(frozen=True)
class Judge:
    model: Model | Tables
    intercept: float
    slope: float


def learn(docs: DataFrame, labels: DataFrame, most: int = MODEL_ROWS) -> Judge:
    """Counts and curve from all labelled documents of their folds."""
    marks = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .withColumn("_fold", fold(F.col("doc_id")))
        .filter(F.col("_fold") != HELD_OUT)
        .groupBy("doc_id", "_fold")
        .agg(F.max("toxic").alias("toxic"))
    )
    marks = dimension(_saved(marks, "labels"), LABELS_BROADCAST)
    labelled = docs.select("doc_id", "text").join(marks, "doc_id")
    words = _saved(vocabulary(labelled.filter(F.col("_fold") != CURVE)), "vocabulary")
    model = build(_saved(gram_counts(words), "grams"), most=most)
    curve = with_difference(labelled.filter(F.col("_fold") == CURVE), model)
    place = F.floor(_stretched(F.col("_difference")) / BIN)
    bins = curve.groupBy(place.alias("bin")).agg(F.count_if(F.col("toxic") == 0).alias("n0"), F.count_if(F.col("toxic") == 1).alias("n1"))
    rows = bins.toPandas().sort_values("bin")  # as many rows as bins, some hundreds
    x = (rows["bin"].to_numpy(float) + 0.5) * BIN
    return Judge(model, *logistic(x, rows["n0"].to_numpy(float), rows["n1"].to_numpy(float)))


def score(docs: DataFrame, judge: Judge, text: str = "text") -> DataFrame:
    """`docs` with score and predicted; columns of those names are replaced."""
    at = F.lit(judge.intercept) + F.lit(judge.slope) * _stretched(F.col("_difference"))
    told = with_difference(docs.drop("score", "predicted"), judge.model, text)
    scored = told.withColumn("score", 1.0 / (1.0 + F.exp(-F.greatest(F.least(at, F.lit(500.0)), F.lit(-500.0)))))
    return scored.drop("_difference").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = tx.documents(spark, sf_dir).select("doc_id", "text")
    judge = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = (fold(F.col("doc_id")) == HELD_OUT).alias("held_out")
    return score(docs, judge).select("doc_id", held_out, "score", "predicted")
