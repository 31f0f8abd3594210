"""Quality classifier: Bradley-Terry scores, learnt from preference pairs.

A pair is a good and a bad document; the good one should score higher. Scores are linear in text
features, so the chance that a beats b is the logistic function of w . (f(a) - f(b)), and w is the
minimiser of the logistic loss on feature differences (Newton steps on a few dozen numbers). The
decision point is a quantile of the learnt scores: the share of bad rows among the labelled ones.

Features are built-in expressions over one row and scores a built-in expression over features: the
corpus is scanned without shuffle or Python. Only the fit sees rows on the driver: features of at
most `max_labelled` rows (a parameter), taken by hash from the learn fold of the labels.

Defined cases: a null or empty text has features 0 and gets a score like any other; labels that are
null or not 0/1 are ignored; of several labels of a document the largest counts; with labels of
one kind or none, all scores are 0.5 and predicted is 1; repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.functions.columns import computed_once
from monthlake.llm import text as tx

MAX_LABELLED = 12_000
PAIRS_PER_ROW = 8
L2 = 1e-3
STEPS = 30
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "der", "die", "und", "de", "la", "le", "et", "el", "que", "y", "en"]


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def features(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """`_row` (the input row) and one double for each feature, with the features' names."""
    body = F.coalesce(F.col("_t"), F.lit(""))
    parts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_t")
    ).select(
        "_row",
        tx.words(F.col("_t")).alias("_w"),
        F.regexp_replace(body, r"[^#*$%&|<>!?.,;:=_~^@/\\()\[\]{}\"'0-9A-Z\n-]+", "").alias("_s"),
    )
    counts = parts.select(
        "_row",
        F.size("_w").alias("n"),
        F.char_length(F.array_join("_w", "")).alias("chars"),
        F.size(F.array_distinct("_w")).alias("distinct"),
        F.size(F.filter("_w", lambda w, i: w == F.get(F.col("_w"), i - 1))).alias("again"),
        F.size(F.filter("_w", lambda w: w.isin(STOP_WORDS))).alias("stops"),
        tx.count_of(F.col("_s"), "#*$%&<>=_~^@").alias("symbols"),
        tx.count_of(F.col("_s"), "|").alias("bars"),
        tx.count_of(F.col("_s"), "!").alias("bangs"),
        tx.count_of(F.col("_s"), ".").alias("stopsigns"),
        tx.count_of(F.col("_s"), "\n").alias("breaks"),
        tx.count_of(F.col("_s"), "0123456789").alias("digits"),
        tx.count_of(F.col("_s"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("upper"),
    )
    n, chars = F.col("n"), F.col("chars")
    made = {
        "log_words": F.log1p(n),
        "word_length": _ratio(chars, n),
        "distinct": _ratio(F.col("distinct"), n),
        "distinct_root": _ratio(F.col("distinct"), F.sqrt(n)),
        "again": _ratio(F.col("again"), n),
        "stops": _ratio(F.col("stops"), n),
        "symbols": F.least(_ratio(F.col("symbols"), n), F.lit(1.0)),
        "bars": F.least(_ratio(F.col("bars"), n), F.lit(1.0)),
        "bangs": F.least(_ratio(F.col("bangs"), n), F.lit(1.0)),
        "sentences": _ratio(F.col("stopsigns"), n),
        "breaks": _ratio(F.col("breaks"), n),
        "digits": _ratio(F.col("digits"), chars),
        "upper": _ratio(F.col("upper"), chars),
    }
    return counts.select("_row", *[v.cast("double").alias(f"_f_{k}") for k, v in made.items()]), [f"_f_{k}" for k in made]


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    weights: tuple[float, ...]
    means: tuple[float, ...]
    threshold: float

    def score(self) -> Column:
        """The chance that the text beats one that lies on the decision point."""
        terms = [(F.col(n) - m) * w for n, w, m in zip(self.names, self.weights, self.means, strict=True)]
        total = reduce(lambda a, b: a + b, terms, F.lit(-self.threshold))
        return 1.0 / (1.0 + F.exp(-F.greatest(F.least(total, F.lit(500.0)), F.lit(-500.0))))


def pairs(good: np.ndarray, bad: np.ndarray, per_row: int = PAIRS_PER_ROW) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of preference pairs: every row takes part `per_row` times at least."""
    n = per_row * max(len(good), len(bad))
    k = np.arange(n)
    return good[k % len(good)], bad[(k * 7919 + k // len(good)) % len(bad)]


def bradley_terry(diff: np.ndarray, l2: float = L2, steps: int = STEPS) -> np.ndarray:
    """argmin of the mean of log(1 + exp(-diff . w)) + l2/2 |w|^2, by damped Newton steps."""
    w = np.zeros(diff.shape[1])

    def loss(v):
        return np.logaddexp(0, -(diff @ v)).mean() + l2 / 2 * v @ v

    for _ in range(steps):
        lose = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))
        grad = -(diff.T @ lose) / len(diff) + l2 * w
        hess = (diff.T * (lose * (1 - lose))) @ diff / len(diff) + l2 * np.eye(len(w))
        step, t = np.linalg.solve(hess, grad), 1.0
        while loss(w - t * step) > loss(w) and t > 1e-4:
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-8:
            break
    return w


def fit_rows(x: np.ndarray, y: np.ndarray, names: list[str]) -> Model:
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model(tuple(names), (0.0,) * len(names), (0.0,) * len(names), 0.0)
    mean, scale = x.mean(0), np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    z = (x - mean) / scale
    a, b = pairs(good, bad)
    w = bradley_terry(z[a] - z[b])
    s = np.sort(z @ w)
    cut = len(bad)  # so many rows should lie below the decision point
    threshold = (s[cut - 1] + s[min(cut, len(s) - 1)]) / 2
    return Model(tuple(names), tuple(map(float, w / scale)), tuple(map(float, mean)), float(threshold))


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on at most max_labelled labelled documents of the learn fold, the first by hash of the id.

    Only labels whose hash is below a share taken from their count are sorted, about as many as wanted. Of
    several texts of a labelled id the one of the smallest hash is learnt.
    """
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("_y"), F.xxhash64("doc_id").alias("_hash")).filter(
        F.col("_y").isin(0, 1) & F.col("doc_id").isNotNull() & ~tx.held_out(F.col("doc_id"))
    )
    n = marks.agg(F.approx_count_distinct("_hash", 0.02)).first()[0]
    # xxhash64 is even over all longs; a fifth more than wanted covers the error of the count.
    share = (F.col("_hash") / float(1 << 63) + 1) / 2
    sample = (
        marks.filter(share * n < 1.2 * max_labelled)
        .groupBy("_hash", "doc_id")
        .agg(F.max("_y").alias("_y"))
        .orderBy("_hash", "doc_id")
        .limit(max_labelled)
    )
    marked = docs.select("doc_id", "text").join(F.broadcast(sample.drop("_hash")), "doc_id")  # at most max_labelled rows
    featured, names = features(marked)
    one = F.min_by(F.struct(F.col("_row._y").alias("_y"), *names), F.xxhash64("_row.text"))
    rows = featured.groupBy(F.col("_row.doc_id").alias("doc_id")).agg(one.alias("_f")).select("doc_id", "_f.*").toPandas()
    rows = rows.sort_values(["doc_id", *names], kind="stable")
    return fit_rows(rows[names].to_numpy(float), rows["_y"].to_numpy(), names)


def score(self) -> Column:
        """The chance that the text beats one that lies on the decision point."""
        terms = [(F.col(n) - m) * w for n, w, m in zip(self.names, self.weights, self.means, strict=True)]
        total = reduce(lambda a, b: a + b, terms, F.lit(-self.threshold))
        return 1.0 / (1.0 + F.exp(-F.greatest(F.least(total, F.lit(500.0)), F.lit(-500.0))))


def pairs(good: np.ndarray, bad: np.ndarray, per_row: int = PAIRS_PER_ROW) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of preference pairs: every row takes part `per_row` times at least."""
    n = per_row * max(len(good), len(bad))
    k = np.arange(n)
    return good[k % len(good)], bad[(k * 7919 + k // len(good)) % len(bad)]


def bradley_terry(diff: np.ndarray, l2: float = L2, steps: int = STEPS) -> np.ndarray:
    """argmin of the mean of log(1 + exp(-diff . w)) + l2/2 |w|^2, by damped Newton steps."""
    w = np.zeros(diff.shape[1])

    def loss(v):
        return np.logaddexp(0, -(diff @ v)).mean() + l2 / 2 * v @ v

    for _ in range(steps):
        lose = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))
        grad = -(diff.T @ lose) / len(diff) + l2 * w
        hess = (diff.T * (lose * (1 - lose))) @ diff / len(diff) + l2 * np.eye(len(w))
        step, t = np.linalg.solve(hess, grad), 1.0
        while loss(w - t * step) > loss(w) and t > 1e-4:
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-8:
            break
    return w


def fit_rows(x: np.ndarray, y: np.ndarray, names: list[str]) -> Model:
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model(tuple(names), (0.0,) * len(names), (0.0,) * len(names), 0.0)
    mean, scale = x.mean(0), np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    z = (x - mean) / scale
    a, b = pairs(good, bad)
    w = bradley_terry(z[a] - z[b])
    s = np.sort(z @ w)
    cut = len(bad)  # so many rows should lie below the decision point
    threshold = (s[cut - 1] + s[min(cut, len(s) - 1)]) / 2
    return Model(tuple(names), tuple(map(float, w / scale)), tuple(map(float, mean)), float(threshold))


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on at most max_labelled labelled documents of the learn fold, the first by hash of the id."""
    sample = (
        labels.select("doc_id", F.col("quality").cast("int").alias("_y"))
        .filter(F.col("_y").isin(0, 1) & F.col("doc_id").isNotNull() & ~tx.held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_y")
        .limit(max_labelled)
        .groupBy("doc_id")
        .agg(F.max("_y").alias("_y"))
    )
    marked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most max_labelled rows
    featured, names = features(marked)
    rows = featured.select(F.col("_row.doc_id").alias("doc_id"), F.col("_row._y").alias("_y"), *names).toPandas()
    rows = rows.sort_values(["doc_id", *names], kind="stable")
    return fit_rows(rows[names].to_numpy(float), rows["_y"].to_numpy(), names)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`_row` (the input row), score and predicted."""
    featured, _ = features(docs, text)
    # Else a filter on the verdict would carry copies of all feature expressions below it.
    scored = computed_once(featured, "score", model.score()).select("_row", "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = tx.documents(spark, sf_dir).select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        F.col("_row.doc_id").alias("doc_id"), tx.held_out(F.col("_row.doc_id")).alias("held_out"), "score", "predicted"
    )
