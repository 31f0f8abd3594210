"""op5 on rows that repeat a vec_id under other labels or with other vectors."""

from collections import Counter

import numpy as np
import pytest

from monthlake.llm import embedding_dedup

from .test_dedup import groups


@pytest.mark.parametrize("tile", [embedding_dedup.TILE, 4])
def test_one_id_in_several_classes(batches, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rng = np.random.default_rng(11)
    base = rng.normal(size=(4, 12))
    near = lambda k: (base[k] + rng.normal(size=12) * 0.01).astype("float32").tolist()
    rows = [(1, near(0), 0), (1, near(1), 1), (1, near(2), 0)]  # one id: two labels, two vectors of a label
    rows += [(2, near(0), 0), (3, near(0), 0), (4, near(1), 1), (5, near(2), 0), (6, near(3), 1), (7, near(3), 0)]
    rows += [(4, rows[1][1], 1), (2, rows[3][1], 0)]  # equal vectors under another id, and under the same
    x = [np.array(v, np.float32).astype(float) for _, v, _ in rows]
    unit = [v / np.linalg.norm(v) for v in x]
    at = range(len(rows))
    links = [(i, j) for i in at for j in range(i) if rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.93]
    root = groups(at, links)
    want = []
    for i in at:
        least = min(rows[j][0] for j in at if root[j] == root[i])
        want.append((rows[i][0], sum(i in link for link in links), least, rows[i][0] == least))
    got = embedding_dedup.near_duplicates(batches.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()) == Counter(want)
