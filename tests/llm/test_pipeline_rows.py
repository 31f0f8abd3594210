"""The pipeline's dedup stages on rows: repeated and null ids, and passages of just over 50 words."""

import pytest

import corpus_pipeline
from monthlake.llm import suffix_dedup
from monthlake.session import shared_folder

from .conftest import DOCS, SMALL, prose
from .test_dedup import edited, passage_corpus, repeats


def staged(batches, docs, names):
    """Rows of the stages named, each written and read again as in the pipeline."""
    stages = dict(corpus_pipeline.STAGES)
    for name in names:
        path = shared_folder(batches, name)
        stages[name](batches, docs, SMALL).write.parquet(path)
        docs = batches.read.parquet(path)
    return docs.collect()


def test_one_row_of_each_group_stays(batches):
    twice, null, pair, near, alone, other, bare = (prose(500 + i, 120) for i in range(7))
    rows = [
        (1, twice), (1, twice),  # a copy under the same id
        (2, null), (None, null),  # a copy without an id
        (None, pair), (None, pair),
        (3, near), (3, edited(near, 1, 1)), (None, edited(near, 1, 2)),
        (4, other), (9, other), (9, alone),  # a unique text under the id of a copy
        (None, bare), (5, None), (5, None), (6, "  "), (6, "  "),
    ]
    docs = batches.createDataFrame([(i, t, "en", f"s{n}") for n, (i, t) in enumerate(rows)], DOCS).repartition(3)
    left = sorted([(r.doc_id, r.text) for r in staged(batches, docs, ["minhash_dedup"])], key=repr)
    ids = [(i, t) for i, t in left if t not in (near, edited(near, 1, 1))]
    assert ids == sorted(
        [(1, twice), (2, null), (None, pair), (4, other), (9, alone), (None, bare), (5, None), (5, None), (6, "  "), (6, "  ")],
        key=repr,
    )
    assert len(left) == len(ids) + 1 and 3 in {i for i, _ in left}
    after = [r.text for r in staged(batches, docs, ["minhash_dedup", "suffix_dedup"])]
    for text in (twice, null, pair, alone, other, bare):
        assert len(text) >= 400 and after.count(text) == 1


def test_a_passage_of_55_words_is_cut(batches):
    passage = " ".join(prose(600, 70).split()[:55])
    assert 51 * 5 < len(passage) < 400
    own = [(prose(610 + i, 90), prose(620 + i, 90)) for i in range(3)]
    docs = batches.createDataFrame([(i, f"{a} {passage} {b}", "en", "s1") for i, (a, b) in enumerate(own)], DOCS)
    got = {r.doc_id: r.text for r in staged(batches, docs, ["minhash_dedup", "suffix_dedup"])}
    for i, (a, b) in enumerate(own):
        assert passage not in got[i] and len(got[i]) <= len(a) + len(b)
        # A neighbour's byte may happen to be the same in two texts.
        assert got[i].startswith(a[:-3]) and got[i].endswith(b[3:])


@pytest.mark.parametrize("length,hot", [(corpus_pipeline.PASSAGE, suffix_dedup.HOT_BYTES), (101, 1), (64, 3000)])
def test_other_lengths_equal_brute_force(batches, make, monkeypatch, length, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 4000)
    texts = passage_corpus()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(make(texts), length).collect()}
    assert [got[i] for i in range(len(texts))] == repeats(texts, length)
