"""Hard negatives against all scores."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast.llm import negatives, queries


def by_hand(rows, anchors, k=5, n=5):
    """rows: (key, label, vector of whole numbers)."""
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for a, label, v in anchors:
        scored = sorted((-dot(v, x), key, own == label) for key, own, x in rows if key != a)
        for s, p, same in [x for x in scored if x[2]][:k]:
            found = [(t, key) for t, key, other in scored if not other and 80 * -s <= 100 * -t <= 100 * -s][:n]
            out += [(a, p, i, key, -s, -t) for i, (t, key) in enumerate(found, 1)]
    return sorted(out)


def clustered(rng, n, width, spread, centres=12):
    c = rng.normal(size=(centres, width)) * 200
    return np.round(c[rng.integers(0, centres, n)] + rng.normal(size=(n, width)) * spread).astype(np.int64)


@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_spanning_tree(n):
    rng = np.random.default_rng(n)
    v = clustered(rng, n, 8, 20)
    parent, edge = negatives.spanning_tree(v)
    t = negatives.tree_of(np.arange(n), np.zeros(n, int), v)
    assert sorted(t.keys.tolist()) == list(range(n)) and (parent < 0).sum() == 1
    assert all(p < i for i, p in enumerate(t.parent.tolist()))
    for i, p in enumerate(t.parent.tolist()):
        if p >= 0:
            assert np.isclose(t.edge[i], np.linalg.norm(t.vectors[i] - t.vectors[p]))
            assert t.last[i] == (i == max(j for j in range(n) if t.parent[j] == p))
    away = np.linalg.norm(v[:, None].astype(float) - v[None], axis=2)  # Kruskal's total, by hand
    group, total = list(range(n)), 0.0
    for d, i, j in sorted((away[i, j], i, j) for i in range(n) for j in range(i)):
        if group[i] != group[j]:
            total += d
            group = [group[i] if g == group[j] else g for g in group]
    assert np.isclose(np.sqrt(edge).sum(), total)


def test_bounds_hold_and_spare_scores():
    rng = np.random.default_rng(5)
    v, x = clustered(rng, 60, 16, 3), clustered(np.random.default_rng(5), 4000, 16, 3)
    tree = negatives.tree_of(np.arange(60), np.zeros(60, int), v)
    rows = negatives.Rows(np.arange(100, 4100), np.zeros(4000, int), x)

    def wanted(c, low, high):
        true = x @ tree.vectors[c]
        assert (low <= true).all() and (true <= high).all()
        return high >= np.sort(true)[-5]

    for c, at, scores in negatives.walk(tree, rows, wanted):
        assert (scores == x[at] @ tree.vectors[c]).all()
    best = [negatives.Best(5) for _ in range(60)]
    taken = negatives.add_positives(tree, rows, best)
    for c, b in enumerate(best):
        assert b.scores.tolist() == np.sort(x @ tree.vectors[c])[::-1][:5].tolist()
    assert taken < 0.25 * 60 * 4000  # most rows are never scored at most anchors


@pytest.mark.parametrize("scale", [1, 1 << 20])
def test_scores_are_exact_in_large_numbers_too(scale):
    rng = np.random.default_rng(1)
    x, v = rng.integers(-60, 60, (50, 6)) * scale + 1, rng.integers(-60, 60, 6) * scale + 1
    want = [sum(int(a) * int(b) for a, b in zip(r, v, strict=True)) for r in x]
    assert negatives.Rows(np.arange(50), np.zeros(50), x).scores(v).tolist() == want


@pytest.mark.parametrize("block,room", [(512, 32 << 20), (4, 600)])
def test_mine_on_edge_cases(spark, monkeypatch, block, room):
    """Ties, repeated rows, short vectors, nulls; one tree in one round, and several trees in many rounds."""
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "ROUND_BYTES", room)
    rng = random.Random(4)
    rows = [(i, rng.randint(0, 2), [rng.randint(-3, 9) for _ in range(4)]) for i in range(150)]
    rows += [(150, 0, [5, 5]), (151, 1, []), (152, 2, [9, 9, 9, 9, 9]), (153, 1, [1] * 4), (153, 1, [1] * 4), (200, 1, [2, 2, 2, 2])]
    bad = [(None, 1, [9] * 4), (300, None, [9] * 4), (310, 1, None), (320, 1, [9, None, 9, 9])]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows + bad], "vec_id long, label int, vector array<long>, key string, score int")
    got = negatives.mine(docs, F.col("vec_id") % 10 == 0).collect()
    anchors = [r for r in rows if r[0] % 10 == 0]
    assert sorted(map(tuple, got)) == by_hand(rows, anchors) and len(got) > 100
    assert got[0].asDict().keys() == {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"}


def test_mine_without_rows_or_anchors(spark):
    docs = spark.createDataFrame([(1, 0, [1, 2]), (2, 1, [3, 4])], "vec_id long, label int, vector array<long>")
    assert negatives.mine(docs.limit(0), F.lit(True)).count() == 0
    assert negatives.mine(docs, F.lit(False)).count() == 0
    assert negatives.mine(docs, F.lit(None).cast("boolean")).count() == 0
    assert negatives.mine(docs, F.lit(True)).count() == 0  # no row of the same label


def test_query_against_brute_force(spark):
    given = queries.table(spark, "/root/testdata/sf0.001", "embeddings").collect()
    rows = [(r.vec_id, (r.label + (r.vec_id % 7 == 0)) % 10, np.floor(256.0 * np.array(r.embedding, np.float64)).astype(int).tolist()) for r in given]
    got = queries.op13_anchor_tree_negatives(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == by_hand(rows, [r for r in rows if r[0] % 100 == 0])
