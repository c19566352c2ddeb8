import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm.hard_negatives import Walk, mine_hard_negatives, spanning_tree

SCHEMA = "vec_id bigint, embedding array<{}>, label int, length int, a int, c int, rank int, score double"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 0.5) for r in rows], SCHEMA.format(kind)).repartition(4)


def mine(df, **options):
    return mine_hard_negatives(df, F.col("vec_id") % 10 == 0, **options)


def by_hand(rows, positives=5, negatives=3, window=(50, 95)):
    usable = {}
    for key, vector, label in rows:
        fine = vector is not None and all(x is not None and math.isfinite(x) for x in vector)
        if key is not None and label is not None and fine:
            usable[key] = min(usable.get(key, (label, vector)), (label, vector))
    whole = {k: (label, [math.floor(256 * x) for x in v]) for k, (label, v) in usable.items()}
    found = []
    for anchor, (label, a) in whole.items():
        if anchor % 10:
            continue
        scores = [
            (-sum(x * y for x, y in zip(a, b)), key, own == label)
            for key, (own, b) in whole.items()
            if key != anchor and len(a) == len(b)
        ]
        for p, positive in sorted((s, k) for s, k, same in scores if same)[:positives]:
            fit = [(n, k) for n, k, same in scores if not same and window[0] * -p <= 100 * -n <= window[1] * -p]
            for rank, (n, k) in enumerate(sorted(fit)[:negatives], 1):
                found.append((anchor, positive, rank, k, -p, -n))
    return sorted(found)


def awkward(dimensions=8):
    rng = random.Random(4)

    def draw(middle=0.0):
        return [float(np.float32(rng.gauss(middle, 1))) for _ in range(dimensions)]

    rows = [(i, draw(0.5), i % 3) for i in range(200)]
    rows += [(200 + i, rows[7][1], i % 2) for i in range(80)]  # one vector under two labels
    rows += [(300, None, 1), (310, [], 1), (311, [], 2), (320, [0.0] * dimensions, 1), (330, [0.0] * dimensions, 2)]
    rows += [(340, [float("nan")] * dimensions, 1), (350, [None] * dimensions, 1), (360, draw(), None)]
    rows += [(370, [1.0, 2.0], 1), (371, [2.0, 2.0], 1), (372, [1.0, 1.0], 2), (380, draw(), 77), (None, draw(), 1)]
    return rows + [(10, rows[10][1], 1), (10, draw(), 2), (390, [-x for x in rows[7][1]], 1)]


@pytest.mark.parametrize("blocks", [(1024, 16384), (3, 40), (1, 1000)])
def test_equals_brute_force(spark, blocks):
    found = mine(frame(spark, awkward()), anchor_block=blocks[0], candidate_block=blocks[1])
    assert sorted(map(tuple, found.collect())) == by_hand(awkward())


def test_other_numbers(spark):
    options = {"positives": 2, "negatives": 7, "window": (10, 100)}
    found = mine(frame(spark, awkward()), **options)
    assert sorted(map(tuple, found.collect())) == by_hand(awkward(), **options)


@pytest.mark.parametrize("size", [1e5, 5e5])
def test_large_numbers_are_exact(spark, size):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(9) * size + rng.randrange(3) for _ in range(4)], i % 2) for i in range(90)]
    found = mine(frame(spark, rows, "double"), anchor_block=4, candidate_block=30)
    assert sorted(map(tuple, found.collect())) == by_hand(rows)


def test_scores_beyond_a_long_are_the_nearest_long(spark):
    rows = [(0, [1e300], 1), (1, [1e300], 1), (2, [-1e300], 1), (3, [1e200], 2), (4, [6e299], 2)]
    found = mine(frame(spark, rows, "double"))
    assert [tuple(r)[:4] for r in found.collect() if r.positive_id == 2] == []
    assert {r.positive_score for r in found.collect()} <= {2**63 - 1}


def test_few_rows(spark):
    assert mine(frame(spark, [])).collect() == []
    assert mine(frame(spark, [(0, [1.0], 1)])).collect() == []
    assert mine(frame(spark, [(0, [1.0], 1), (1, [1.0], 1)])).collect() == []
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]
    assert [tuple(r) for r in mine(frame(spark, rows)).collect()] == [(0, 1, 1, 2, 65536, 32768)]


def test_tree_is_of_least_length():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 50, (40, 2)).astype(float)
    squares = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    edges = spanning_tree(squares)
    seen = {0}
    for parent, child in edges:
        assert parent in seen and child not in seen
        seen.add(child)
    assert len(seen) == 40
    joined = {i: i for i in range(40)}  # by taking the shortest edges first

    def find(i):
        while joined[i] != i:
            i = joined[i]
        return i

    total = 0.0
    for square, i, j in sorted((squares[i, j], i, j) for i in range(40) for j in range(i)):
        if find(i) != find(j):
            joined[find(i)] = find(j)
            total += math.sqrt(square)
    assert math.isclose(sum(math.sqrt(squares[e]) for e in edges), total)


def test_bounds_hold_and_spare_scores():
    rng = np.random.default_rng(2)
    anchors = (rng.integers(-100, 100, (1, 16)) + rng.integers(-3, 4, (30, 16))).astype(float)
    candidates = rng.integers(-100, 100, (500, 16)).astype(float)
    scores = anchors @ candidates.T
    least = np.sort(scores, axis=1)[:, -5]

    def wanted(i, low, high):
        assert (low <= scores[i]).all() and (scores[i] <= high).all()
        return high >= least[i]

    scored = 0
    for i, at, exact in Walk(anchors)(candidates, wanted):
        assert (exact == scores[i][at]).all()
        assert set(np.flatnonzero(scores[i] >= least[i])) <= set(at.tolist())
        scored += len(at)
    assert scored < scores.size / 2
