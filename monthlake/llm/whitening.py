"""Embedding whitening: leading principal components by Chebyshev-filtered subspace iteration.

The covariance is never formed. An iteration works on a block of directions Q (dimensions x block,
some kilobytes): one pass over the rows gives the centred product XᵀXQ, a sum over tasks that Spark
adds up. The block is filtered by a Chebyshev polynomial of the covariance (three-term recurrence,
a pass for each degree), which is small on [0, cut], cut being the smallest Ritz value of the
block, and grows fast above it. From the second filter on the interval begins at a bound below the spectrum, found by
Lanczos steps that ride along with the first one's passes: the narrower the interval, the fewer passes. Then QR and Rayleigh-Ritz. The iteration stops when the residuals
|Vq - eq| of the wanted components are certified to be below `TOLERANCE` times the largest
eigenvalue. A last pass measures the covariance of the whitened values themselves.

Sums are centred before they are multiplied. The driver sees one row for each dimension, whatever the
number of rows or tasks.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped,
and so are those with a component of `LIMIT` or more, which no long could carry exactly. Vectors of
different length are fitted apart, each length over its own rows. Components whose eigenvalue is zero to
working precision (constant or dependent dimensions, fewer rows than components) are left out; a
single row or equal rows give none, hence no rows. Every row counts, repeated ids and null ids too; a
deviation beyond a long is null. Extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthlake.llm.vector_codes import _matrix, _saved, usable

COMPONENTS = 8
GUARD = 24  # directions in the block beyond the wanted ones
DEGREE = 12
TOLERANCE = 1e-13
MAX_ITERATIONS = 60
RANK = 1e-12  # eigenvalues below this share of the largest count as zero
SCALE, SHIFT = 1024, 100_000
LIMIT = float(1 << 40)


def integers(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, dim and x (integers) of the usable rows."""
    x = F.transform("embedding", lambda c: (F.floor(c.cast("double") * scale) + shift).cast("long"))
    return vectors.filter(usable(limit=LIMIT)).select("vec_id", F.size("embedding").alias("dim"), x.alias("x"))


def _summed(rows: DataFrame, dim: int, width: int, kind: str, part) -> np.ndarray:
    """Sum over all tasks of the dim x width matrices that `part` makes of a task's batches."""
    names = ["pos", *[f"c{j}" for j in range(width)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, width), np.int64 if kind == "long" else np.float64)
        for batch in batches:
            if batch.num_rows:
                total += part(_matrix(batch["x"]))
        arrays = [pa.array(np.arange(dim))] + [pa.array(total[:, j]) for j in range(width)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "pos long, " + ", ".join(f"{n} {kind}" for n in names[1:])
    total = rows.select("x").mapInArrow(run, schema).groupBy("pos").agg(*[F.sum(n).alias(n) for n in names[1:]])
    out = np.zeros((dim, width), np.int64 if kind == "long" else np.float64)
    for r in total.collect():  # dim rows
        out[r.pos] = r[1:]
    return out


@dataclass(frozen=True)
class Fit:
    n: int
    sums: np.ndarray  # of each dimension, exact
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # columns
    trace: float
    identity_error: float
    residual: float  # largest |Vq - eq| over the largest eigenvalue
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n


def chebyshev(apply, q: np.ndarray, aq: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """p(V)q for the scaled Chebyshev polynomial that is small on [low, cut] and 1 in size at `top`."""
    c, e = (cut + low) / 2, (cut - low) / 2
    sigma = first = e / (top - c)
    before, now = q, (aq - c * q) * (sigma / e)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (apply(now) - c * now) * (2 * after / e) - (sigma * after) * before
        sigma = after
    return now


class LowEnd:
    """A bound below the spectrum, by Lanczos steps on one vector that rides along with the block's passes."""

    def __init__(self, dim: int):
        v = np.random.default_rng(20240312).standard_normal(dim)
        self.basis, self.alpha, self.beta = [v / np.linalg.norm(v)], [], []

    def riding(self, apply):
        """`apply` with the next Lanczos vector as a further column."""

        def both(q: np.ndarray) -> np.ndarray:
            out = apply(np.column_stack([q, self.basis[-1]]))
            self._step(out[:, -1])
            return out[:, :-1]

        return both

    def _step(self, w: np.ndarray) -> None:
        self.alpha.append(float(self.basis[-1] @ w))
        for v in self.basis:  # orthogonal to all, twice, against rounding
            w = w - (v @ w) * v
        for v in self.basis:
            w = w - (v @ w) * v
        self.beta.append(float(np.linalg.norm(w)))
        self.basis.append(w / self.beta[-1] if self.beta[-1] > 0 else w)

    def bound(self) -> float:
        """The least Ritz value less the norm of what the last step left."""
        if not self.alpha:
            return 0.0
        t = np.diag(self.alpha) + np.diag(self.beta[:-1], 1) + np.diag(self.beta[:-1], -1)
        return max(0.0, float(np.linalg.eigvalsh(t)[0]) - self.beta[-1])


def leading_components(apply, dim: int, wanted: int, guard: int = GUARD, degree: int = DEGREE):
    """Eigenvalues (falling), unit eigenvectors and the largest relative residual of the `wanted`
    leading components of a positive semidefinite operator; `apply` maps dim x m to dim x m."""
    block = min(dim, wanted + guard)
    q = np.linalg.qr(np.random.default_rng(20240311).standard_normal((dim, block)))[0]
    low_end, low = LowEnd(dim), 0.0
    best = None
    stalled = 0
    for turn in range(MAX_ITERATIONS):
        aq = apply(q)
        small = q.T @ aq
        theta, u = np.linalg.eigh((small + small.T) / 2)
        theta, u = theta[::-1], u[:, ::-1]
        q, aq = q @ u, aq @ u
        k = min(wanted, block)
        if theta[0] <= 0:
            return theta[:0], q[:, :0], 0.0
        residual = float(np.linalg.norm(aq[:, :k] - q[:, :k] * theta[:k], axis=0).max() / theta[0])
        if best is None or residual < best[2]:
            best, stalled = (theta[:k].copy(), q[:, :k].copy(), residual), 0
        else:
            stalled += 1  # rounding of the passes is reached
        if residual <= TOLERANCE or (stalled >= 2 and best[2] <= 100 * TOLERANCE):
            return best
        cut = max(float(theta[-1]), 1e-6 * float(theta[0]))
        low = min(low, 0.9 * cut)
        # The first filter takes [0, cut]; its passes tell how far up the interval may begin.
        filtered = chebyshev(low_end.riding(apply) if turn == 0 else apply, q, aq, low, cut, float(theta[0]), degree)
        q = np.linalg.qr(filtered)[0]
        low = low_end.bound()
    raise RuntimeError(f"components are not certified after {MAX_ITERATIONS} iterations: residual {best[2]}")


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Fit:
    """Fit on all `rows` (x of length dim)."""
    n = rows.count()
    sums = _summed(rows, dim, 1, "long", lambda x: x.sum(axis=0)[:, None])[:, 0]
    mean = sums / n
    passes = 0

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ q)

        return _summed(rows, dim, q.shape[1], "double", part) / n

    spread = _summed(rows, dim, 1, "double", lambda x: ((x - mean) ** 2).sum(axis=0)[:, None])
    trace = float(spread.sum() / n)
    if trace == 0:
        return Fit(n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0, 0.0, 0.0, 0)
    values, vectors, residual = leading_components(apply, dim, components)
    keep = values > RANK * values[0]
    values, vectors = values[keep], vectors[:, keep]
    whiten = vectors / np.sqrt(values)
    k = len(values)

    def whitened(x: np.ndarray) -> np.ndarray:
        out = np.zeros((dim, k + 1))
        z = (x - mean) @ whiten
        out[:k, :k], out[:k, k] = z.T @ z, z.sum(axis=0)
        return out

    told = _summed(rows, dim, k + 1, "double", whitened) / n
    cov = told[:k, :k] - np.outer(told[:k, k], told[:k, k])
    error = float(np.abs(cov - np.eye(k)).max()) if k else 0.0
    return Fit(n, sums, values, vectors, trace, error, residual, passes)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    most = int(np.abs(x).max()) * n + int(np.abs(sums).max())
    if most < 1 << 62:
        gap = n * x - sums
        if int(np.abs(gap).max()) ** 2 * x.shape[1] < 1 << 63:
            return (gap * gap).sum(axis=1).tolist()
    gap = x.astype(object) * n - sums.astype(object)
    return [v if v < 1 << 63 else None for v in (gap * gap).sum(axis=1).tolist()]


def transform(rows: DataFrame, model: Fit) -> DataFrame:
    """A row for each row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    schema = T.StructType(
        [rows.schema["vec_id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
         T.StructField("deviation", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]
    )
    k = len(model.values)
    whiten, mean = model.vectors / np.sqrt(model.values), model.mean
    explained = model.values / model.trace if model.trace else model.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch["x"])
            each = np.repeat(np.arange(len(x)), k)
            deviation = pa.array(_deviations(x, model.n, model.sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"].take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.n)),
                    deviation.take(pa.array(each)),
                    pa.array(((x - mean) @ whiten).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), model.identity_error)),
                ],
                names=schema.names,
            )

    return rows.select("vec_id", "x").mapInArrow(run, schema)


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, dict[int, Fit]]:
    """Whitened rows and the fit of each vector length."""
    rows = _saved(integers(vectors), "integers")
    fits, out = {}, []
    for r in rows.select("dim").distinct().orderBy("dim").collect():
        own = rows.filter(F.col("dim") == r.dim)
        fits[r.dim] = fit(own, r.dim, components)
        out.append(transform(own, fits[r.dim]))
    if not out:
        none = Fit(0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0, 0.0, 0)
        return transform(rows, none), fits
    return reduce(DataFrame.unionByName, out), fits


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))[0]
