"""The mix against plain arithmetic: caps, nearness, repeats."""

import pytest
from pyspark.sql import functions as F

from monthlake.llm import mixing

from .conftest import prose


def by_hand(sizes):
    """Targets by sharing again and again. `sizes`: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] >= 3 * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in free}
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("counts", [{"a": 900, "b": 30, "c": 5, None: 60}, {"a": 10}, {"a": 1, "b": 1, "c": 4000}])
def test_targets_and_nearness(batches, counts):
    rows, k = [], 0
    for source, n in counts.items():
        while n > 0:
            size = min(n, 1 + k * 7 % 23)
            rows.append((k, prose(k, size), source))
            k, n = k + 1, n - size
    docs = batches.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    want = by_hand(counts)
    for source, n in counts.items():
        own = [r for r in got if r.doc_id is not None and rows[r.doc_id][2] == source]
        assert own[0].source_size == n
        assert own[0].target == pytest.approx(want[source])
        assert abs(sum(r.taken for r in own) - want[source]) <= max(r.size for r in own) / 2 + 1e-6
        assert all(0 <= r.taken <= 3 * r.size for r in own)


def test_rows_repeat_as_taken(batches, make):
    docs = make([prose(i, 5 + i % 9) for i in range(90)] + [None, ""]).withColumn("copies", F.lit("clash"))
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    got = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert got == {k: n for k, n in taken.items() if n and k < 90}


def test_plan_has_no_python(batches, make):
    plan = mixing.mixed_rows(make([prose(i, 9) for i in range(30)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
