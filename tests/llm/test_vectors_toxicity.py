"""Whitening, vector codes and toxicity against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from monthlake.llm import toxicity, vector_codes, whitening

VECTORS = "vec_id long, embedding array<float>, label int"
SMALL = "/root/testdata/sf0.001"


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, VECTORS)
    return frame.withColumns({"x": F.lit("clash"), "code": F.lit(1), "n": F.lit(2), "dim": F.lit(3)}).repartition(3)


def some(n, dim, seed=1):
    r = np.random.default_rng(seed)
    return [(i, [float(np.float32(v)) for v in r.normal(0, 0.3, dim) * np.linspace(2, 1, dim)], i % 3) for i in range(n)]


BAD = [(900, None, 1), (901, [], 1), (902, [None] * 8, 1), (903, [float("nan")] * 8, 2), (904, [float("inf")] * 8, 2)]


# ---------------------------------------------------------------- codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Exhaustive search in plain Python integers."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [[math.floor(256 * c) for c in r[1]] for r in rows]
    x = [v + [0] * (-len(v) % parts) for v in x]
    width = len(x[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in x]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            for i, members in groups.items():
                books[p][i] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    out = []
    for r, v in zip(rows, cut, strict=True):
        found = [nearest(v[p], books[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    flat = ",".join(str(c) for b in books for e in b for c in e)
    return out, hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("n,dim", [(300, 32), (40, 16), (90, 18)])
def test_codes_equal_exhaustive_search(batches, n, dim):
    rows = some(n, dim)
    rows += [(r[0], r[1], None) for r in rows[:5]] + [(None, rows[0][1], 7), (rows[1][0], rows[2][1], 7)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(30)]  # copies
    want, digest = plain_codes(rows)
    coded, books = vector_codes.compress(vectors(batches, rows + BAD))
    got = sorted(((r.vec_id, r.code, r.error) for r in coded.collect()), key=str)
    assert got == sorted(want, key=str)
    assert vector_codes.books_digest(books[dim]) == digest


def test_orchard_ties_and_equal_entries():
    r = np.random.default_rng(3)
    for size in (1, 2, 17, 64):
        book = r.integers(-3, 4, (size, 2))  # many equal entries and ties
        queries = r.integers(-5, 6, (500, 2))
        codes, errors = vector_codes.orchard(queries, book, vector_codes.neighbour_lists(book))
        far = ((queries[:, None] - book[None]) ** 2).sum(2)
        assert (codes == far.argmin(1)).all() and (errors == far.min(1)).all()


def test_orchard_skips_entries():
    """The search looks at few of the entries where they are spread out."""
    book = np.stack([np.arange(64) * 100, np.zeros(64, int)], axis=1)
    near, far = vector_codes.neighbour_lists(book)
    looked = Counter()

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, tuple) and isinstance(at[0], np.ndarray):
                looked["steps"] += len(at[0])
            return super().__getitem__(at)

    queries = np.stack([np.arange(500) % 150, np.ones(500, int)], axis=1)
    vector_codes.orchard(queries, book, (near.view(Counted), far))
    assert looked["steps"] < 500 * 8


def test_codes_query(batches, folder):
    rows = some(70, 16)
    path = folder(embeddings=vectors(batches, [(i, v, None if i % 4 == 0 else i % 2) for i, v, _ in rows] + BAD))
    got = vector_codes.op13_vector_codes(batches, path)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    told = {r.vec_id: r for r in got.collect()}
    assert set(told) == set(range(70)) and len({r.codebooks_sha256 for r in told.values()}) == 1
    nulls = [r for i, r in told.items() if i % 4 == 0]
    assert {r.label_error for r in nulls} == {sum(r.error for r in nulls)}
    none = folder(embeddings=vectors(batches, BAD))
    assert vector_codes.op13_vector_codes(batches, none).collect() == []


def test_codes_of_two_lengths(batches):
    rows = some(30, 16) + [(100 + i, v, 0) for i, v, _ in some(20, 32, seed=2)]
    coded, books = vector_codes.compress(vectors(batches, rows))
    assert set(books) == {16, 32} and coded.count() == 50
    assert {r.code for r in coded.filter("dim = 32").collect()} == {c for _, c, _ in plain_codes(rows[30:])[0]}


# ---------------------------------------------------------------- whitening


def plain_whitened(rows, k=8):
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for v in rows], dtype=object)
    n, s = len(x), x.sum(0)
    deviation = [int(((n * v - s) ** 2).sum()) for v in x]
    y = x.astype(float) - (s / n).astype(float)
    values, q = np.linalg.eigh(y.T @ y / n)
    values, q = values[::-1][:k], q[:, ::-1][:, :k]
    keep = values > 1e-12 * values[0]
    return deviation, y @ q[:, keep] / np.sqrt(values[keep]), values[keep] / (y * y).sum() * n


@pytest.mark.parametrize("n,dim", [(400, 64), (200, 40), (30, 5), (6, 64)])
def test_whitening_equals_eigenvectors(batches, n, dim):
    rows = some(n, dim)
    out, fits = whitening.whitened(vectors(batches, rows + BAD))
    deviation, w, explained = plain_whitened([r[1] for r in rows])
    got = out.toPandas().sort_values(["vec_id", "component"])
    k = w.shape[1]
    assert len(got) == n * k and got["component"].tolist() == [*range(1, k + 1)] * n
    assert got["deviation"].tolist() == [d for d in deviation for _ in range(k)]
    g = got["whitened"].to_numpy().reshape(n, k)
    g = g * np.sign((g * w).sum(0))
    assert np.abs(g - w).max() < 1e-8
    assert np.allclose(got["explained"].to_numpy()[:k], explained, rtol=1e-10)
    assert (got["n"] == n).all() and got["identity_error"].max() < 1e-10
    assert fits[dim].residual < 1e-11


def test_whitening_counts_repeated_rows_and_two_lengths(batches):
    rows = some(50, 12)
    more = rows + rows[:20] + [(None, rows[0][1], 1)]
    out, _ = whitening.whitened(vectors(batches, more + [(500 + i, v, 0) for i, v, _ in some(9, 3)]))
    got = out.toPandas()
    assert (got[got.vec_id.isna() | (got.vec_id < 500)]["n"] == 71).all() and (got[got.vec_id >= 500]["n"] == 9).all()
    assert set(got[got.vec_id >= 500]["component"]) == {1, 2, 3}
    _, w, _ = plain_whitened([r[1] for r in more])
    g = got[(got.vec_id == 49) & (got.component == 1)]["whitened"].iloc[0]
    assert abs(abs(g) - abs(w[49, 0])) < 1e-8


def test_whitening_without_spread(batches):
    same = [(i, [0.5, 0.25], 1) for i in range(4)]
    assert whitening.whitened(vectors(batches, same))[0].collect() == []
    assert whitening.whitened(vectors(batches, BAD))[0].collect() == []
    line = [(i, [0.5 * i, 1.0 * i, 3.0], 1) for i in range(5)]
    assert {r.component for r in whitening.whitened(vectors(batches, line))[0].collect()} == {1}


def test_close_eigenvalues_need_the_filter():
    """Components a thousandth apart among 200 dimensions, within few passes."""
    r = np.random.default_rng(5)
    values = np.concatenate([1 + 1e-3 * np.arange(8)[::-1], np.linspace(0.9, 0.1, 192)])
    q = np.linalg.qr(r.standard_normal((200, 200)))[0]
    a = (q * values) @ q.T
    passes = []
    theta, vectors_, residual = whitening.leading_components(lambda b: passes.append(1) or a @ b, 200, 8)
    assert np.allclose(theta, values[:8], atol=1e-12) and residual < 1e-11 and len(passes) < 200
    assert np.abs(np.abs(vectors_.T @ q[:, :8]) - np.eye(8)).max() < 1e-8


def test_deviation_beyond_a_long():
    x = np.array([[3, 1], [0, 0]], dtype=np.int64)
    assert whitening._deviations(x, 10, np.array([5, 5])) == [25**2 + 5**2, 50]
    big = np.array([[1 << 40], [1]], dtype=np.int64)
    assert whitening._deviations(big, 1 << 10, np.array([1024])) == [None, 0]


# ---------------------------------------------------------------- toxicity

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(bytes((text or "").encode()).lower())


def plain_model(rows, order=8, sigma=4.0, rare=1 << 18):
    """rows: (text, toxic). Returns the log ratio of a word, by dictionaries."""
    seen = [set(), set()]
    for text, y in rows:
        w = words_of(text)
        seen[y].update(zip([None, *w], w, strict=False))
    gram, first, size = [Counter(), Counter()], [Counter(), Counter()], Counter()
    for y in (0, 1):
        for w, m in Counter(w for _, w in seen[y]).items():
            s = b" " + w + b" "
            for i in range(1, len(s)):
                for k in range(min(i, order - 1) + 1):
                    gram[y][s[i - k : i + 1]] += m
                    first[y][s[i - k : i]] += m
    # Counts by length of n-gram: the sum over all first bytes of that length.
    for y in (0, 1):
        for g, c in gram[y].items():
            size[len(g)] += c
    over, rest = [{}, {}], [{}, {}]
    for g in set(gram[0]) | set(gram[1]):
        f = g[:-1]
        n = first[0][f], first[1][f]
        c = gram[0][g], gram[1][g]
        if min(n) and sum(c) * rare >= size[len(g)]:
            d = sigma * math.sqrt(sum(c) / sum(n) / min(n))
            for y in (0, 1):
                v = c[y] / n[y] - d
                if v > 0:
                    over[y][g] = v
                    rest[y][f] = rest[y].get(f, 1.0) - v
    singles = Counter()
    for y in (0, 1):
        for g, c in gram[y].items():
            if len(g) == 1:
                singles[g] += c
    total = sum(singles.values()) + 256

    def ratio(w):
        s, out = b" " + w + b" ", 0.0
        for i in range(1, len(s)):
            p = [(singles[s[i : i + 1]] + 1) / total] * 2
            for k in range(min(i, order - 1) + 1):
                g = s[i - k : i + 1]
                p = [over[y].get(g, 0.0) + rest[y].get(g[:-1], 1.0) * p[y] for y in (0, 1)]
            out += math.log(p[1] / p[0])
        return out

    return ratio


def difference(text, ratio, share=toxicity.SHARE):
    w = words_of(text)
    return sum(math.log1p(share * math.expm1(min(ratio(x), 30.0))) for x in w) / max(1, len(w))


def test_toxicity_equals_plain_version(batches):
    """Counts, discounts and likelihoods of sf0.001, word by word and text by text."""
    docs = batches.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    marks = {r.doc_id: r.toxic for r in batches.read.parquet(f"{SMALL}/labels.parquet").collect() if r.toxic is not None}
    rows = [(d.text, marks[d.doc_id]) for d in docs if d.doc_id in marks and zlib.crc32(str(d.doc_id).encode()) % 5 in (1, 2, 3)]
    ratio = plain_model(rows)
    labelled = batches.createDataFrame([*rows, *rows[:7]], "text string, toxic int").repartition(5)
    counts = toxicity.vocabulary(labelled)
    model = toxicity.build(toxicity.gram_counts(counts))
    assert len(model.keys) > 100
    words = sorted({w for d in docs for w in words_of(d.text)})[:4000]
    got = toxicity.word_ratios(words, model)
    assert np.abs(got - [ratio(w) for w in words]).max() < 1e-9
    texts = pa.array([d.text for d in docs])
    assert np.allclose(toxicity.differences(texts, model), [difference(d.text, ratio) for d in docs], atol=1e-12)


def test_toxicity_scores_equal_plain_version(batches, folder):
    """The whole query: counts from folds 1 to 3, curve from fold 4."""
    docs = batches.read.parquet(f"{SMALL}/documents.parquet")
    labels = batches.read.parquet(f"{SMALL}/labels.parquet")
    judge = toxicity.learn(docs, labels)
    ratio = plain_model(
        [(r.text, r.toxic) for r in docs.join(labels, "doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 in (1, 2, 3)]
    )
    for r in toxicity.score(docs, judge).select("doc_id", "text", "score", "predicted").collect():
        at = judge.intercept + judge.slope * math.log(max(0.0, difference(r.text, ratio)) + 1e-4)
        assert r.score == pytest.approx(1 / (1 + math.exp(-at)), abs=1e-9)
        assert r.predicted == int(r.score >= 0.5)


def test_toxicity_on_held_out_rows(batches):
    path = "/root/testdata/sf0.1"
    got = toxicity.op12_toxicity(batches, path)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(batches.read.parquet(f"{path}/labels.parquet"), "doc_id").filter("held_out and toxic is not null").collect()
    assert len(rows) > 500
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.97
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.9


def test_toxicity_keeps_rare_grams_and_joins_a_large_model(batches):
    """An n-gram rarer than one in 2^18 of its order counts; a model kept as tables gives the same scores."""
    spread = 5 << 40  # pooled counts of the order, of which `rare` is far less than one in 2^18
    grams = [(ord("a"), 0, 1, spread, spread), (ord("b"), 0, 1, 10, 10)]
    grams += [(ord("a") << 8 | ord(x), ord("a"), 2, c0, c1) for x, c0, c1 in (("x", spread, 0), ("y", 0, spread))]
    grams += [(ord("b") << 8 | ord(x), ord("b"), 2, c0, c1) for x, c0, c1 in (("x", 100, 0), ("y", 0, 100))]
    counts = batches.createDataFrame(grams, "key long, first long, size int, c0 long, c1 long")
    assert ord("b") << 8 | ord("x") in toxicity.build(counts).keys

    docs, labels = (batches.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text").unionByName(docs.select((F.col("doc_id") + 10**6).alias("doc_id"), F.lit("plain words; plain").alias("text")).limit(9))
    want, got = toxicity.learn(docs, labels), toxicity.learn(docs, labels, most=10)
    assert isinstance(want.model, toxicity.Model) and isinstance(got.model, toxicity.Tables)
    assert (got.intercept, got.slope) == pytest.approx((want.intercept, want.slope), abs=1e-9)
    rows = [{r.doc_id: r.score for r in toxicity.score(docs, j).select("doc_id", "score").collect()} for j in (want, got)]
    assert rows[1] == pytest.approx(rows[0], abs=1e-9) and len(rows[0]) > 200


def test_curve():
    x = np.array([0.0, 1.0, 2.0, 3.0])
    a, b = toxicity.logistic(x, np.array([50.0, 20, 5, 0]), np.array([0.0, 5, 20, 50]))
    assert b > 1 and a + b * 1.5 == pytest.approx(0, abs=0.1)
    assert toxicity.logistic(x, np.ones(4), np.zeros(4))[1] == 0
    assert toxicity.logistic(np.zeros(0), np.zeros(0), np.zeros(0)) == (math.log(1 / 3), 0.0)


def test_toxicity_cases(batches, awkward, empty, folder):
    clash = awkward.withColumn("score", F.lit("x")).withColumn("toxic", F.lit(9)).withColumn("_fold", F.lit(3))
    some_labels = [(i, y) for i in range(1, 11) for y in (i % 2, None)] + [(5, 0), (5, 1), (None, 1), (7, 3)]
    labels = batches.createDataFrame(some_labels, "doc_id long, toxic int")
    path = folder(documents=clash, labels=labels)
    rows = toxicity.op12_toxicity(batches, path).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1  # no words
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    one_class = folder(documents=clash, labels=labels.filter("toxic = 0"))
    assert {r.predicted for r in toxicity.op12_toxicity(batches, one_class).collect()} == {0}
    none = folder(documents=clash, labels=labels.filter("false"))
    assert {r.score for r in toxicity.op12_toxicity(batches, none).collect()} == {0.25}
    assert toxicity.op12_toxicity(batches, folder(documents=empty, labels=labels)).collect() == []


def test_a_long_word_and_blocks(monkeypatch):
    """Words that span several blocks of places are judged alike."""
    r = random.Random(1)
    words = [bytes(r.choice(b"abc") for _ in range(n)) for n in (1, 3, 500, 2, 9)]
    keys = np.array(sorted({int.from_bytes(w[i : i + 3], "big") for w in words for i in range(len(w) - 2)}), np.uint64)
    firsts = np.unique(keys >> np.uint64(8))
    model = toxicity.Model(keys, np.full((2, len(keys)), [[0.1], [0.3]]), firsts, np.full((2, len(firsts)), [[0.5], [0.2]]), np.full(256, 1 / 256))
    whole = toxicity.word_ratios(words, model)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert np.allclose(toxicity.word_ratios(words, model), whole)
