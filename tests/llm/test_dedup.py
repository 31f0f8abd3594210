"""Near-duplicates, repeated passages and embeddings against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthlake.llm import components, embedding_dedup, minhash, suffix_dedup

from .conftest import prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def groups(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, k):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = WORD.findall(lower)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def edited(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def test_one_id_with_several_texts(batches):
    """Rows that repeat a doc_id are judged each by its own text; links of neither are lost."""
    for trial in range(3):
        a, b, c = (prose(700 + 10 * trial + i, 150) for i in range(3))
        rows = [(1, a), (1, b), (5, edited(a, 2, 1)), (6, edited(b, 2, 2)), (7, c), (7, edited(a, 2, 3)), (2, c), (None, a)]
        docs = batches.createDataFrame(rows, "doc_id long, text string").repartition(4)
        found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, k=4).collect() if r.doc_id)
        sets = [shingles(t, 4) for _, t in rows]
        links = [
            (i, j) for i in range(7) for j in range(i)
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
        ]
        whose = groups(range(7), links)
        least = {g: min(rows[i][0] for i in whose if whose[i] == g) for g in set(whose.values())}
        assert found == sorted((rows[i][0], len(sets[i]), least[whose[i]]) for i in range(7))


def near_corpus():
    texts = [prose(i, 30 + i) for i in range(20)]
    base = prose(100, 200)
    texts += [edited(base, i % 12, i) for i in range(120)]  # around the threshold
    texts += [base.upper(), base, base, "a b", "A  b", "a", None, "", "a b c", "x " * 500]
    # A chain whose ends are not alike, and boilerplate that many share without being alike.
    chain = base + " chain"
    for i in range(12):
        chain = edited(chain, 4, 900 + i)
        texts.append(chain)
    notice = prose(200, 60)
    texts += [notice + " " + prose(300 + i, 40) for i in range(70)]
    return texts


@pytest.mark.parametrize("small_bucket", [minhash.SMALL_BUCKET, 2])
@pytest.mark.parametrize("k", [4, 5])
def test_minhash_equals_brute_force(batches, make, monkeypatch, small_bucket, k):
    monkeypatch.setattr(minhash, "SMALL_BUCKET", small_bucket)
    monkeypatch.setattr(minhash, "TILE", 16)
    texts = near_corpus()
    sets = [shingles(t, k) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    want = groups(range(len(texts)), links)
    got = {r.doc_id: r for r in minhash.near_duplicates(make(texts), k=k).collect()}
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in enumerate(sets)}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_minhash_awkward(batches, awkward, empty):
    rows = minhash.near_duplicates(awkward.withColumn("sig", F.lit(1)).withColumn("key", F.lit(2)), k=4).collect()
    assert len(rows) == awkward.count()
    assert {(r.component_id, r.kept) for r in rows if r.doc_id in (5, 6)} == {(5, True), (5, False)}
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, False)]
    assert all(r.n_shingles == 0 and r.kept for r in rows if r.doc_id in (1, 2, 3))
    assert minhash.near_duplicates(empty, k=4).count() == 0


def test_posterior_bound():
    """The cut of each batch is the smallest count whose posterior tail reaches the miss chance."""
    for n, m in minhash.least_matches(80, 1e-3).items():
        x = np.random.default_rng(n).beta(m + 1, n - m + 1, 400_000)
        assert (x >= 0.8).mean() > 3e-4
        if m:
            y = np.random.default_rng(n).beta(m, n - m + 2, 400_000)
            assert (y >= 0.8).mean() < 2e-3


def repeats(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for b in raw:
        hit = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                hit[p : p + length] = True
        spans = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~hit])
        out.append((len(b), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passage_corpus():
    p, q = prose(1, 90), prose(2, 75).replace("a", "é")
    texts = [prose(10 + i, 60) + " " + p + " " + prose(50 + i, 40) for i in range(8)]
    texts += [p[i:] + prose(80 + i, 30) for i in range(0, 60, 7)]
    texts += [q + prose(90, 9) + q, "z" * 1500, "ab" * 400, "z" * 399, "z" * 400, None, "", p, p]
    texts += [edited(prose(7, 300), n, n) for n in (0, 1, 2, 3)]
    texts += ["漢字かな" * 60 + prose(95, 50), "x" + "漢字かな" * 60, "\x00" * 450 + "a", "b" + "\x00" * 450]
    return texts


@pytest.mark.parametrize("hot,part", [(suffix_dedup.HOT_BYTES, suffix_dedup.PART), (1, 64), (3000, 500)])
def test_suffix_equals_brute_force(batches, make, monkeypatch, hot, part):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "segments", _with_part(part))
    texts = passage_corpus()
    rows = suffix_dedup.digests(make(texts)).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert [got[i] for i in range(len(texts))] == repeats(texts)


def _with_part(part):
    real = suffix_dedup.segments

    def run(data):
        suffix_dedup.PART = part
        return real(data)

    return run


def test_suffix_removal_keeps_rows(batches, make, awkward, empty):
    texts = passage_corpus()
    docs = make(texts).withColumn("key", F.lit("k")).withColumn("cut", F.lit("c")).withColumn("row_id", F.lit(7))
    out = suffix_dedup.remove(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    want = [x[3] for x in repeats(texts)]
    whole = [i for i, t in enumerate(texts) if t is not None and "é" not in t and "漢" not in t]
    assert len(got) == len(texts) and got[texts.index(None)] is None
    assert all(hashlib.sha256(got[i].encode()).hexdigest() == want[i] for i in whole)
    assert suffix_dedup.digests(awkward).count() == awkward.count()
    assert suffix_dedup.digests(empty).count() == 0 and suffix_dedup.remove(empty).count() == 0


def test_sub_shards_are_merged_by_binary_search():
    """Repeats within and between sub-shards of one anchor, against all strings in one dictionary."""
    rng = np.random.default_rng(8)
    common = rng.integers(97, 101, 300, dtype=np.uint8).tobytes()
    for pieces in (2, 3, 7):
        shards = []
        for _ in range(pieces):
            parts = [rng.integers(97, 101, n, dtype=np.uint8).tobytes() for n in rng.integers(60, 200, 6)]
            at = rng.integers(0, 200, 4)
            parts += [common[a : a + 90] for a in at] + [parts[0][:40] + parts[1], b"a" * 120]
            shards.append(sorted(set(parts)))
        where = {}
        for s, parts in enumerate(shards):
            for i, part in enumerate(parts):
                for k in range(len(part) - 64 + 1):
                    where.setdefault(part[k : k + 64], []).append((s, i, k))
        want = {x for v in where.values() if len(v) > 1 for x in v}
        across = {v for v, x in where.items() if len({s for s, _, _ in x}) > 1}
        got, met = set(), {}
        for s, parts in enumerate(shards):
            marks, later = suffix_dedup.repeated_starts(parts, 64)
            got |= {(s, i, int(k)) for i, m in enumerate(marks) for k in np.flatnonzero(m)}
            listed = np.concatenate([suffix_dedup.entries(i, p, x, 64) for i, (p, x) in enumerate(zip(parts, later, strict=True))])
            assert len(np.unique(listed["mark"])) == len(listed) == len({p[k : k + 64] for p in parts for k in range(len(p) - 63)})
            cut = suffix_dedup.slices(listed, pieces)
            assert sum(len(x) for _, x in cut) == len(listed)
            for n, piece in cut:
                met.setdefault(n, []).append((s, piece))
        assert len(met) == pieces
        found = set()
        for lists in met.values():
            flags = suffix_dedup.in_several([np.ascontiguousarray(x["mark"]) for _, x in lists])
            for (s, x), flag in zip(lists, flags, strict=True):
                found |= {(s, int(e["content"]), int(e["start"])) for e in x[flag]}
        assert {shards[s][i][k : k + 64] for s, i, k in found} == across and len(across) > 20
        assert got | found == want


def test_suffix_array_and_prefixes():
    r = random.Random(3)
    parts = [bytes(r.choice(b"ab\x00") for _ in range(r.randint(1, 60))) for _ in range(30)] + [b"a" * 70, b"a" * 70]
    sizes = np.array([len(p) for p in parts])
    ends_of = np.cumsum(sizes)
    data, ends = np.frombuffer(b"".join(parts), np.uint8), np.repeat(ends_of, sizes)
    order = suffix_dedup.suffix_array(data, ends)
    suffix = lambda p: ([x + 1 for x in data[p : ends[p]].tolist()] + [0], int(ends[p]))
    assert order.tolist() == sorted(range(len(data)), key=suffix)
    lcp = suffix_dedup.common_prefixes(data, ends_of - sizes, ends, order)
    for a, b in zip(order[:-1], order[1:], strict=True):
        x, y = bytes(data[a : ends[a]]), bytes(data[b : ends[b]])
        n = next((i for i, (c, d) in enumerate(zip(x, y, strict=False)) if c != d), min(len(x), len(y)))
        assert lcp[b] == n


def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 24))
    rows = [(i, (base[i % 6] + rng.normal(size=24) * 0.12 * (i % 4)).astype("float32").tolist(), i % 2) for i in range(160)]
    same = rows[0][1]
    rows += [(200 + i, same, 0) for i in range(9)] + [(220, same, 1), (221, same, None), (222, None, 0), (None, same, 0)]
    rows += [(223, [0.0] * 24, 0), (224, [float("nan")] * 24, 0), (225, [], 0), (226, [1.0, None], 0), (227, [float("inf")] + [1.0] * 23, 0)]
    rows += [(228, [x * 1e30 for x in same], 0), (229, [2.0], 0), (230, [3.0], 0), (231, [-1.0], 0)]
    return rows


@pytest.mark.parametrize("tile", [embedding_dedup.TILE, 8])
def test_embeddings_equal_brute_force(batches, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rows = vectors()
    df = batches.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and None not in v:
            x = np.array(v, np.float32).astype(float)
            if np.isfinite(x).all() and x.any():
                good[i] = (label, x / np.abs(x).max())
    links = [
        (i, j) for i in good for j in good
        if j < i and good[i][0] == good[j][0] and len(good[i][1]) == len(good[j][1])
        and good[i][1] @ good[j][1] / np.linalg.norm(good[i][1]) / np.linalg.norm(good[j][1]) >= 0.93
    ]
    ids = [i for i, _, _ in rows if i is not None]
    comp, n = groups(ids, links), dict.fromkeys(ids, 0)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df.withColumn("n", F.lit(1))).collect()}
    assert len(got) == len(rows) and (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert {i: got[i].n_links for i in ids} == n
    assert {i: got[i].component_id for i in ids} == comp
    assert all(got[i].kept == (comp[i] == i) for i in ids)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components(batches):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(60)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(70)]
    links += links[:20] + [(b, a) for a, b in links[:20]] + [(7, 7)]
    df = batches.createDataFrame(links, "a long, b long")
    ids = {x for a, b in links if a != b for x in (a, b)}
    got = components.components(df).collect()
    assert len(got) == len(ids)
    assert {x.id: x.component for x in got} == groups(ids, [x for x in links if x[0] != x[1]])
    assert components.components(df.limit(0)).count() == 0
