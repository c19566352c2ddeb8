import hashlib
import math
import random

import numpy as np
import pytest

from scorekit.llm.clusters import LIMB, _limbs, _means, build_tree, cluster, nearest_centroids
from scorekit.llm.integers import LONGEST, alike, floors, roots_above, roots_below

SCHEMA = "vec_id bigint, embedding array<{}>, cluster int, distance bigint, label int, components string"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 9, 8, 7, "x") for r in rows], SCHEMA.format(kind)).repartition(5)


def by_hand(rows, clusters, rounds, dimensions):
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [math.floor(256 * x) for x in vector]))

    def name(row):
        return (row[0] is None, hashlib.sha256(f"2:{row[0]}".encode()).hexdigest(), row[1])

    centroids = [v for _, v in sorted(kept, key=name)[:clusters]]

    def assign():
        found = []
        for _, v in kept:
            found.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids)))
        return found

    for _ in range(rounds):
        found = assign()
        for i in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == i]
            if own:
                centroids[i] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    total = sum(d for d, _ in found)
    result = []
    for (key, _), (d, c) in zip(kept, found):
        inertia = sum(x for x, y in found if y == c)
        digest = hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
        result.append((key, c, min(d, LONGEST), min(inertia, LONGEST), min(total, LONGEST), digest))
    return sorted(result, key=repr)


def awkward(dimensions):
    rng = random.Random(2)

    def draw(scale):
        return [float(np.float32(rng.gauss(0, scale))) for _ in range(dimensions)]

    rows = [(i, draw(1)) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # one vector many times over
    rows += [(5, rows[5][1]), (5, draw(1)), (None, draw(1)), (None, None)]
    rows += [(400, None), (401, []), (402, draw(1)[1:]), (403, [float("nan"), *draw(1)[1:]])]
    return rows + [(404, [float("inf"), *draw(1)[1:]]), (405, [None, *draw(1)[1:]])]


@pytest.mark.parametrize("clusters, rounds, dimensions", [(12, 3, 4), (40, 2, 64), (1, 2, 3), (500, 1, 2)])
def test_equals_brute_force(spark, clusters, rounds, dimensions):
    rows = awkward(dimensions)
    found = cluster(frame(spark, rows), clusters, rounds, dimensions).collect()
    assert sorted(map(tuple, found), key=repr) == by_hand(rows, clusters, rounds, dimensions)


@pytest.mark.parametrize("size", [1e6, 1e12, 1e30, 1e300])
def test_numbers_of_any_size_are_exact(spark, size):
    rng = random.Random(3)
    rows = [(i, [rng.choice((-1, 0, 1)) * size + rng.randrange(3) for _ in range(3)]) for i in range(60)]
    rows += [(100, [1e308, 0.0, 0.0])]  # its 256-fold is no finite number
    wanted = by_hand(rows[:60], 7, 3, 3)
    found = cluster(frame(spark, rows, "double"), 7, 3, 3).collect()
    assert sorted(map(tuple, found), key=repr) == wanted


def test_tables_without_a_vector_that_is_kept(spark):
    assert cluster(frame(spark, [])).collect() == []
    assert cluster(frame(spark, [(1, None), (2, [1.0])])).collect() == []


@pytest.mark.parametrize("spread", [1, 2, 50])
def test_tree_gives_the_smallest_number_of_equal_distances(spread):
    rng = np.random.default_rng(spread)
    vectors = rng.integers(-spread, spread + 1, (400, 3)).astype(float)
    centroids = rng.integers(-spread, spread + 1, (70, 3)).astype(float)
    squares = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    number, distance = nearest_centroids(vectors, centroids, build_tree(centroids))
    assert (number == squares.argmin(axis=1)).all() and (distance == squares.min(axis=1)).all()


def test_tree_leaves_centroids_out():
    """Vectors near one of some far centroids do not meet all of them."""
    centroids = (np.arange(400) * 1000.0).reshape(-1, 1)
    met = []

    class Counting(list):
        def __getitem__(self, i):
            met.append(i)
            return super().__getitem__(i)

    tree = build_tree(centroids)
    number, _ = nearest_centroids(np.array([[77_003.0]]), centroids, Counting(tree))
    assert number.tolist() == [77] and len(met) < len(tree) / 4


def test_roots_enclose():
    squares = np.array([0, 1, 2, 3, 4, 2**49 - 1, 2**49, (2**24 + 1) ** 2, (2**24 + 1) ** 2 - 1], float)
    for values in (squares, np.array([int(x) for x in squares] + [10**60, 10**60 + 1], object)):
        above, below = roots_above(values), roots_below(values)
        for square, a, b in zip(values, above, below):
            square, a, b = int(square), int(a), int(b)
            assert (a - 1) ** 2 < square <= a**2 or square == a == 0
            assert b**2 <= square < (b + 1) ** 2


def test_limbs_keep_sums_whole():
    sums = np.array([[0, 5, -5, 1 << 80, -(1 << 80) - 3, -(1 << LIMB), (1 << LIMB) - 1]], object)
    batches = [_limbs(np.array([3]), sums), _limbs(np.array([4]), sums)]
    rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
    wanted = [2 * int(x) // 7 for x in sums[0]]
    assert _means(rows, np.zeros((1, 7)))[0].tolist() == wanted


def test_floors():
    assert floors(np.array([[-0.001, 0.999, -1.0]]), 256).tolist() == [[-1, 255, -256]]
    left, right = alike(np.zeros((1, 2)), floors(np.full((1, 2), 1e30), 256))
    assert left.dtype == right.dtype == object
