"""Quality and language: held-out accuracy, and defined cases."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthlake.llm import language_id, quality_classifier
from monthlake.llm.queries import QUERIES

from .conftest import DOCS, SMALL

MIDDLE = "/root/testdata/sf0.01"


def test_quality_held_out(batches):
    got = QUERIES["op1_quality_classifier"](batches, MIDDLE)
    labels = batches.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 80
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_awkward(batches, awkward, empty):
    labels = batches.createDataFrame([(5, 1), (5, 0), (7, 0), (9, None), (10, 0), (3, 7)], "doc_id long, quality int")
    model = quality_classifier.learn(awkward, labels)
    rows = quality_classifier.score(awkward.withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r._row.doc_id == 5}.__len__() == 1
    assert quality_classifier.score(empty, model).count() == 0
    none = quality_classifier.learn(awkward, labels.filter("false"))
    assert {(r.score, r.predicted) for r in quality_classifier.score(awkward, none).collect()} == {(0.5, 1)}


def test_bradley_terry_is_the_minimum():
    rng = np.random.default_rng(1)
    diff = rng.normal(size=(400, 3)) + [0.5, 0.0, -1.0]
    w = quality_classifier.bradley_terry(diff, l2=0.1)
    loss = lambda v: np.logaddexp(0, -(diff @ v)).mean() + 0.05 * v @ v
    assert all(loss(w) <= loss(w + 0.01 * rng.normal(size=3)) for _ in range(50))


def test_language_held_out(batches):
    got = QUERIES["op3_language_id"](batches, MIDDLE)
    docs = batches.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98


def test_language_awkward(batches, awkward, empty):
    docs = awkward.unionByName(batches.read.parquet(f"{SMALL}/documents.parquet").select(awkward.columns))
    model = language_id.learn(docs)
    got = language_id.predict(awkward.withColumn("score", F.lit("x")), model)
    rows = got.collect()
    assert len(rows) == awkward.count() and got.columns.count("score") == 1
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert language_id.predict(empty, model).count() == 0
    assert {r.lang_pred for r in language_id.predict(awkward, language_id.learn(empty)).collect()} == {"und"}


def test_presence_is_the_hashed_set():
    row = np.zeros(language_id.PLACES, bool)
    language_id.presence("Ab, ab!", row)
    other = np.zeros(language_id.PLACES, bool)
    language_id.presence("ab  AB ab", other)
    assert (row == other).all() and row.sum() <= 12 and row.any()


# ---------------------------------------------------------------- plain versions

GAPS = re.compile("[\x20\x09-\x0d]+")


def plain_features(text):
    text = text or ""
    w = [x for x in GAPS.split(text) if x]
    n, chars = len(w), sum(map(len, w))
    ratio = lambda a, b: a / b if b else 0.0
    many = lambda signs: sum(c in signs for c in text)
    return [
        math.log1p(n), ratio(chars, n), ratio(len(set(w)), n), ratio(len(set(w)), math.sqrt(n)),
        ratio(sum(a == b for a, b in zip(w, w[1:])), n), ratio(sum(x in quality_classifier.STOP_WORDS for x in w), n),
        min(ratio(many("#*$%&<>=_~^@"), n), 1.0), min(ratio(many("|"), n), 1.0), min(ratio(many("!"), n), 1.0),
        ratio(many("."), n), ratio(many("\n"), n), ratio(many("0123456789"), chars),
        ratio(many("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars),
    ]


def test_quality_equals_plain_version(batches):
    """Features, the fitted model and scores of sf0.001, document by document."""
    docs = batches.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = batches.read.parquet(f"{SMALL}/labels.parquet")
    table, names = quality_classifier.features(docs)
    got = {r._row.doc_id: (r._row.text, [r[n] for n in names]) for r in table.collect()}
    for text, row in got.values():
        assert np.allclose(row, plain_features(text), rtol=1e-12, atol=1e-12)
    marks = {r.doc_id: r.quality for r in labels.collect() if r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    ids = sorted(i for i in marks if i in got)
    x, y = np.array([plain_features(got[i][0]) for i in ids]), np.array([marks[i] for i in ids])
    want = quality_classifier.fit_rows(x, y, names)
    model = quality_classifier.learn(docs, labels)
    assert np.allclose(model.weights, want.weights, rtol=1e-6) and model.threshold == pytest.approx(want.threshold, rel=1e-6)
    for r in quality_classifier.score(docs, model).collect():
        at = sum((f - m) * w for f, m, w in zip(plain_features(r._row.text), want.means, want.weights)) - want.threshold
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-500.0, min(500.0, at)))), abs=1e-6)
        assert r.predicted == int(r.score >= 0.5)


def test_a_bounded_sample_of_labels(batches):
    """The first by hash, as many as asked for, whatever repeats; one text of each id."""
    docs = batches.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = batches.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = docs.unionByName(docs).unionByName(docs.limit(1).withColumn("text", F.lit("other")))
    seen = []
    real = quality_classifier.fit_rows
    try:
        quality_classifier.fit_rows = lambda x, y, names: seen.append(len(x)) or real(x, y, names)
        quality_classifier.learn(docs, labels.unionByName(labels), max_labelled=40)
        quality_classifier.learn(docs, labels, max_labelled=10**6)
    finally:
        quality_classifier.fit_rows = real
    assert seen[0] <= 40 < seen[1] <= docs.select("doc_id").distinct().count()


def plain_grams(text):
    """Places of the n-grams of a text's lower-cased letters, as a set."""
    body = b" " + b" ".join(text.lower().encode().translate(language_id._LETTERS).split()) + b" "
    out = set()
    for n in language_id.GRAMS:
        for i in range(len(body) - n + 1):
            out.add((int.from_bytes(body[i : i + n], "big") * language_id._MIX[n] % (1 << 32)) >> 17)
    return out


def test_language_equals_plain_kernels(batches):
    """Kernels between sets, landmarks, map and regression in double precision, text by text."""
    docs = batches.read.parquet(f"{SMALL}/documents.parquet")
    names, matrix = language_id.learn(docs, per_lang=30, landmarks=10)
    rows = language_id.sample_bits(docs, per_lang=30).sort_values(["lang", "_hash"])
    texts = {}
    for r in docs.select("text", F.xxhash64("doc_id", "text").alias("h")).collect():
        texts[r.h] = r.text
    sets = [plain_grams(texts[h]) for h in rows["_hash"]]
    langs = rows["lang"].to_numpy(str)
    assert names == sorted(set(langs)) and all((langs == n).sum() <= 30 for n in names)
    kernel = lambda a, b: len(a & b) / math.sqrt(max(1, len(a)) * max(1, len(b)))
    marks = [i for n in names for i in np.flatnonzero(langs == n)[:10]]
    gram = np.array([[kernel(sets[i], sets[j]) for j in marks] for i in marks])
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-6 * values.max()
    to_map = vectors[:, keep] / np.sqrt(values[keep])
    z = np.array([[kernel(s, sets[j]) for j in marks] for s in sets]) @ to_map
    y = np.where(langs[:, None] == np.array(names)[None, :], 1.0, -1.0)
    each = np.array([1 / (langs == n).sum() for n in langs])
    coef = np.linalg.solve(z.T @ (z * each[:, None]) + language_id.RIDGE * np.eye(z.shape[1]), (z * each[:, None]).T @ y)
    for r in language_id.predict(docs.select("text"), (names, matrix)).collect():
        if not any(c.isalpha() for c in r.text or ""):
            continue
        own = plain_grams(r.text)
        f = np.array([kernel(own, sets[j]) for j in marks]) @ to_map @ coef
        assert r.score == pytest.approx(min(1.0, max(0.0, (f.max() + 1) / 2)), abs=2e-3)
        close = np.sort(f)[-2:] if len(f) > 1 else [0, 1]
        assert r.lang_pred == names[f.argmax()] or close[1] - close[0] < 4e-3


def test_language_sample_of_repeated_rows(batches):
    """A row that repeats many times is one of the sample, and ids that repeat are told apart by text."""
    one = [(7, "ein kleines haus am see", "de", "s")] * 3000
    rows = one + [(7, f"text number {i} of many words", "en", "s") for i in range(50)] + [(i, None, "en", "s") for i in range(5)]
    got = language_id.sample_bits(batches.createDataFrame(rows, DOCS), per_lang=20)
    assert dict(got["lang"].value_counts()) == {"en": 20, "de": 1}
