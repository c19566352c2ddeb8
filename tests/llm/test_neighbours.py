import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm import neighbours
from scorekit.llm.neighbours import nearest, quantise

SCHEMA = "vec_id bigint, embedding array<float>, label int, q int, c int, length int, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 0, 1, 2, 3, 0.5) for r in rows], SCHEMA).repartition(4)


def awkward():
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]  # many equal vectors
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] + [1.0] * 15)]
    rows += [(404, [float("-inf")] + [1.0] * 15), (405, [None] + [1.0] * 15), (None, [1.0] * 16)]
    rows += [(420, [1e-30] * 16), (440, [1e30] * 16), (460, [2.0] * 5), (480, [1.0] * 5), (500, [-1.0] * 3)]
    rows += [(20, rows[20][1]), (20, [99.0] * 16)]  # a repeated row, and another vector of its key
    return rows


def by_hand(rows, k):
    usable = {}
    for key, vector in rows:
        fine = vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector)
        if key is not None and fine:
            vector = [float(np.float32(x)) for x in vector]
            usable[key] = min(usable.get(key, vector), vector)
    found = []
    for q, a in usable.items():
        if q % 20:
            continue
        scores = []
        for key, b in usable.items():
            if key != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a, b):
                    total += x * y
                scores.append((-total, key))
        found += [(q, rank, key, -s) for rank, (s, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("blocks", [(2048, 16384), (5, 40), (1, 1000)])
def test_equals_brute_force(spark, blocks):
    df = vectors(spark, awkward())
    found = nearest(df, F.col("vec_id") % 20 == 0, 20, query_block=blocks[0], candidate_block=blocks[1])
    assert sorted(map(tuple, found.collect())) == by_hand(awkward(), 20)


def test_fewer_candidates_than_asked_for(spark):
    df = vectors(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [0.5, 0.5])])
    rows = nearest(df, F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in sorted(rows)] == [(0, 1, 1, 4.0), (0, 2, 2, 1.5)]
    assert nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    assert nearest(vectors(spark, [(0, [1.0])]), F.col("vec_id") % 20 == 0).collect() == []


def test_rounding_errors_are_bounded():
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 1, (200, 64)) * 10.0 ** rng.integers(-6, 6, (200, 1))
    small, scale, size, error = quantise(vectors)
    unit, back = vectors / scale[:, None], small / 127
    assert np.allclose(np.linalg.norm(unit - back, axis=1), error)
    bound = error[:, None] * size + (size + error)[:, None] * error
    assert (np.abs(unit @ unit.T - back @ back.T) <= bound * (1 + 1e-9) + 1e-12).all()


@pytest.mark.parametrize("blocks", [(2048, 16384), (3, 30)])
def test_numbers_of_any_size(spark, blocks):
    """Squares and products that overflow, that vanish, and sums that are no numbers."""
    rng = random.Random(6)
    rows = []
    for i in range(160):
        size = rng.choice([1e-320, 1e-170, 1e-20, 1.0, 1e20, 1e160, 1e300])
        rows.append((i, [rng.choice((-1, 1)) * rng.choice((0.5, 1.0, 1.5)) * size for _ in range(4)]))
    schema = "vec_id bigint, embedding array<double>"
    df = spark.createDataFrame(rows, schema).repartition(4)
    found = nearest(df, F.col("vec_id") % 20 == 0, 15, query_block=blocks[0], candidate_block=blocks[1]).collect()
    wanted = []
    for q, a in rows[::20]:
        scores = []
        for key, b in rows:
            if key != q:
                total = 0.0
                for x, y in zip(a, b):
                    total += x * y
                scores.append((total != total, -total if total == total else 0.0, key, total))
        wanted += [(q, rank, s[2], repr(s[3])) for rank, s in enumerate(sorted(scores)[:15], 1)]
    assert sorted((r.query_id, r.rank, r.vec_id, repr(r.score)) for r in found) == sorted(wanted)


def test_long_vectors_make_smaller_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_NUMBERS", 64)
    df = vectors(spark, awkward())
    found = nearest(df, F.col("vec_id") % 20 == 0, 20)
    assert found.count() == len(by_hand(awkward(), 20))
