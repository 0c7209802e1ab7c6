import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.llm import tree_negatives as T

COLUMNS = "vec_id long, embedding array<double>, label int, score double, id long, block int, rank int"


def make(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 1, 2, 3) for r in rows], COLUMNS)


def whole(v):
    return [math.floor(256 * x) for x in v]


def brute(rows, every=10, positives=5, negatives=5, percent=80):
    rows = [(i, whole(v), y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x) < 2**18 for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a, v, y in rows:
        if a % every:
            continue
        scores = [(-dot(v, x), i, z) for i, x, z in rows if i != a]
        for p, pos, _ in sorted(s for s in scores if s[2] == y)[:positives]:
            near = sorted(s for s in scores if s[2] != y and percent * -p <= 100 * -s[0] <= 100 * -p)[:negatives]
            out += [(a, pos, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(near)]
    return Counter(out)


def mined(spark, rows, **how):
    df = T.hard_negatives(make(spark, rows), F.col("vec_id") % 10 == 0, **how)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in df.collect())


def some(seed, n, width=6, clusters=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(1, clusters), width))
    v = rng.standard_normal((n, width)) * (0.05 if clusters else 1) + (centres[rng.integers(0, clusters, n)] if clusters else 0)
    return [(i, [float(x) for x in row], int(y)) for i, (row, y) in enumerate(zip(v.round(2), rng.integers(0, 3, n), strict=True))]


@pytest.mark.parametrize("clusters", [0, 5])
def test_as_brute_force_in_small_blocks_and_chunks(spark, clusters, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 37)
    monkeypatch.setattr(T, "CHUNKS", 2)
    rows = some(clusters, 300, clusters=clusters)
    assert mined(spark, rows, block=7) == brute(rows)
    assert mined(spark, rows, block=1000) == brute(rows)


def test_odd_rows(spark):
    rows = some(3, 60)
    rows += [(100, None, 1), (101, [1.0] * 6, None), (None, [1.0] * 6, 1), (110, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (120, [float("nan")] * 6, 1), (130, [float("inf")] * 6, 1), (140, [1e30] * 6, 1)]
    rows += [(150, [], 1), (160, [0.0] * 6, 2), (170, [1.0, 2.0], 0), (3, rows[3][1], 2), (3, rows[3][1], 2), (180, [250_000.0] * 6, 0), (181, [250_000.0] * 6, 0), (182, [249_999.5] * 6, 1)]
    assert mined(spark, rows) == brute(rows)


def test_repeated_anchors_are_rows_of_their_own(spark):
    rows = some(4, 40)
    rows.append(rows[10])
    assert mined(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(0, [1.0], 1)])
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]) == Counter([(0, 1, 1, 2, 65536, 58880)])
    assert not mined(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-1.0], 2)])  # no window below a negative positive


def test_tree_is_least_and_bounds_hold():
    rng = np.random.default_rng(2)
    v = rng.integers(-50, 50, (40, 5)).astype(np.int32)
    tree = T.spanning_tree(v)
    assert sorted(a for a, _, _ in tree) == list(range(40))
    seen = {-1}
    for a, above, _ in tree:
        assert above in seen
        seen.add(a)
    # Kruskal's total over the vectors and zero
    points = np.vstack([v, np.zeros(5)])
    edges = sorted((float(np.linalg.norm(points[i] - points[j])), i, j) for i in range(41) for j in range(i))
    top = list(range(41))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    total = 0.0
    for w, i, j in edges:
        if root(i) != root(j):
            top[root(i)] = root(j)
            total += w
    assert math.isclose(sum(w for _, _, w in tree), total, rel_tol=1e-9)
    x = rng.integers(-50, 50, (200, 5)).astype(np.int32)
    truth = x @ v.T

    def wanted(a, low, high):
        assert (low <= truth[:, a]).all() and (truth[:, a] <= high).all()
        return rng.random(200) < 0.3

    T.walk(tree, v, x, wanted, lambda a, rows, scores: np.testing.assert_array_equal(scores, truth[rows, a]))


def test_bounds_pass_over_most_candidates_of_grouped_vectors():
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((20, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    draw = lambda n: np.floor(256 * (centres[rng.integers(0, 20, n)] + 0.01 * rng.standard_normal((n, 16)))).astype(np.int32)
    v, x = draw(100), draw(2000)
    best = T.Firsts(100, 5)
    scored = T.walk(T.spanning_tree(v), v, x, lambda a, low, high: high >= best.least[a], lambda a, rows, scores: best.add(a, scores, rows))
    assert scored == 100 * 2000  # nothing is known before the first chunk
    again = T.walk(T.spanning_tree(v), v, x, lambda a, low, high: high >= best.least[a], lambda a, rows, scores: None)
    assert again < 0.3 * scored
