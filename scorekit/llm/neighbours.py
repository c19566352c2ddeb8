"""Nearest neighbours by a block matrix join with int8 tiles.

Vectors are dealt into blocks, every block of queries meets every block of candidates in one tile, and
a tile multiplies the vectors as int8. How far such a product can be from the true one is bounded by
the lengths of the rounding errors, so a pair is set aside only if its upper bound is below what at
least k other pairs of the query are sure to reach. The pairs that survive are computed again in double
precision and kept in heaps, of a tile first and then of a query. The answer is exact.
"""

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekit.llm.common import checkpoint

# Vectors in a block on average, numbers that these have together at most, and candidates that are
# multiplied at a time inside a tile.
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 16384
BLOCK_NUMBERS = 1 << 22
STRIP = 1024

# Numbers so near to zero that products lose their digits: what is added to the bounds for them.
TINY = 1e-300


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, not zero, all components finite."""
    wrong = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")).cast("double"))
    )
    return F.coalesce(vector.isNotNull() & ~wrong & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    vector: str = "embedding",
    key: str = "vec_id",
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """The `k` rows with the largest inner products for each row that `queries` selects.

    Returns `query_id, rank, vec_id, score`, nearest first, ties to the smaller key; the row itself is
    no candidate. A query with fewer than `k` candidates gets all of them. Vectors that are null, zero
    or hold a null or a component that is not finite take no part, nor do rows without a key, and a
    vector is compared with those of its own length. A key stands for one vector: of rows that repeat
    it the smallest vector counts. The score is the sum of products in double precision, added in the
    order of the components; where that overflows, infinite scores come first or last, and one that is
    no number comes last of all. An empty table gives an empty result; further columns are not looked at.

    Blocks are drawn by hashed key, so that no tile outgrows its two blocks whatever the vectors are.
    Every query has to meet every candidate: rows shuffled are `queries * candidates / block` of either
    kind, which larger blocks reduce.
    """
    kind = dict(vectors.dtypes)[key]
    rows = vectors.where(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).alias("vec_id"),
        F.col(vector).alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asked"),
    )
    by_key = rows.groupBy("vec_id")
    rows = checkpoint(by_key.agg(F.min("vector").alias("vector"), F.max("asked").alias("asked")))
    asked = rows.where("asked")
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    most = max(1, BLOCK_NUMBERS // longest)
    query_blocks = max(1, -(-asked.count() // min(query_block, most)))
    candidate_blocks = max(1, -(-rows.count() // min(candidate_block, most)))
    block = F.xxhash64("vec_id")
    length = F.size("vector").alias("length")
    left = asked.select(
        "vec_id",
        "vector",
        length,
        F.pmod(block, F.lit(query_blocks)).alias("q"),
        F.explode(_every(candidate_blocks)).alias("c"),
    )
    right = rows.select(
        "vec_id",
        "vector",
        length,
        F.explode(_every(query_blocks)).alias("q"),
        F.pmod(block, F.lit(candidate_blocks)).alias("c"),
    )
    tile = ["length", "q", "c"]
    found = (
        left.groupBy(*tile)
        .cogroup(right.groupBy(*tile))
        .applyInPandas(
            lambda a, b: _tile(a, b, k), f"query_id {kind}, vec_id {kind}, score double"
        )
    )
    merged = found.repartition("query_id").sortWithinPartitions("query_id")
    return merged.mapInArrow(
        lambda batches: _merge(batches, k),
        f"query_id {kind}, rank int, vec_id {kind}, score double",
    )


def _every(blocks: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))


def _tile(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    columns = ["query_id", "vec_id", "score"]
    if not len(queries) or not len(candidates):
        return pd.DataFrame({c: [] for c in columns})
    q_ids, c_ids = queries["vec_id"].to_numpy(), candidates["vec_id"].to_numpy()
    q, c = (np.stack(x["vector"].to_numpy()).astype(np.float64) for x in (queries, candidates))
    q8, q_scale, q_size, q_error = quantise(q)
    heaps: list[list[tuple[float, bool, int]]] = [[] for _ in q_ids]
    # What the k-th of a heap has reached: no pair whose upper bound is below it can matter.
    reached = np.full(len(q_ids), -np.inf)
    for start in range(0, len(c_ids), STRIP):
        strip = slice(start, start + STRIP)
        c8, c_scale, c_size, c_error = quantise(c[strip])
        # Products of int8 vectors are whole numbers that float32 holds exactly up to 2 ** 24, which is
        # enough for 1,040 components; longer vectors are multiplied in double precision.
        wide = np.float32 if q8.shape[1] * 127 * 127 < 1 << 24 else np.float64
        product = (q8.astype(wide) @ c8.astype(wide).T).astype(np.float64) / 127**2
        # |q.c - q'.c'| <= |q - q'| |c| + |q'| |c - c'|
        bound = q_error[:, None] * c_size[None, :] + (q_size + q_error)[:, None] * c_error[None, :]
        bound = bound * (1 + 1e-5) + 1e-6 * q_size[:, None] * c_size[None, :]
        with np.errstate(over="ignore", under="ignore", invalid="ignore"):
            weight = q_scale[:, None] * c_scale[None, :]
            upper, lower = (product + bound) * weight + TINY, (product - bound) * weight - TINY
        beyond = ~np.isfinite(weight)  # nothing is known of scores that large
        upper[beyond], lower[beyond] = np.inf, -np.inf
        own = q_ids[:, None] == c_ids[strip][None, :]
        lower[own], upper[own] = -np.inf, -np.inf
        if lower.shape[1] > k:
            sure = np.partition(lower, lower.shape[1] - k, axis=1)[:, lower.shape[1] - k]
            limit = np.maximum(reached, sure)
        else:
            limit = reached
        at_q, at_c = np.nonzero(~(upper < limit[:, None]) & ~own)
        scores = exact(q, c, at_q, at_c + start)
        at_q, ids, scores = _best(at_q, c_ids[at_c + start], scores, k)
        for i, vec_id, score in zip(at_q.tolist(), ids.tolist(), scores.tolist()):
            _push(heaps[i], k, score, vec_id)
        for i in np.unique(at_q).tolist():
            if len(heaps[i]) == k:
                reached[i] = heaps[i][0][0]
    rows = [(q_id, -minus, _score(*entry)) for q_id, heap in zip(q_ids, heaps) for *entry, minus in heap]
    return pd.DataFrame(rows, columns=columns)


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vectors as int8, of which 127 is the largest component, and that component. Then, of the vectors
    divided by it, so that no square overflows or vanishes, their lengths and what rounding took away."""
    scale = np.abs(vectors).max(axis=1)
    unit = vectors / scale[:, None]
    small = np.rint(unit * 127).astype(np.int8)
    error = np.sqrt(((unit - small / 127) ** 2).sum(axis=1))
    return small, scale, np.sqrt((unit**2).sum(axis=1)), error


def exact(q: np.ndarray, c: np.ndarray, at_q: np.ndarray, at_c: np.ndarray) -> np.ndarray:
    """Inner products of pairs, added component by component, so that equal vectors tie exactly."""
    total = np.zeros(len(at_q))
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        for d in range(q.shape[1]):
            total += q[at_q, d] * c[at_c, d]
    return total


def _placed(scores: np.ndarray) -> np.ndarray:
    """What scores are ordered by: one that is no number comes last."""
    return np.where(np.isnan(scores), -np.inf, scores)


def _best(at_q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The first `k` pairs of each query, so that many equal vectors do not all reach its heap."""
    order = np.lexsort((ids, np.isnan(scores), -_placed(scores), at_q))
    at_q, ids, scores = at_q[order], ids[order], scores[order]
    rank = np.arange(len(at_q)) - np.searchsorted(at_q, at_q)
    return at_q[rank < k], ids[rank < k], scores[rank < k]


def _push(heap: list[tuple[float, bool, int]], k: int, score: float, vec_id: int) -> None:
    """Keep the `k` highest scores, of equal ones the smaller ids. An entry says whether its score is a
    number, as others come after even the lowest."""
    number = score == score
    entry = (score if number else -math.inf, number, -vec_id)
    if len(heap) < k:
        heapq.heappush(heap, entry)
    elif entry > heap[0]:
        heapq.heapreplace(heap, entry)


def _score(score: float, number: bool) -> float:
    return score if number else math.nan


def _merge(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The heaps of all tiles of a query, which come one after the other, made into one."""
    query, heap = None, []
    for batch in batches:
        kind = batch.schema.field("query_id").type
        done = []
        for query_id, vec_id, score in zip(*(column.to_pylist() for column in batch.columns)):
            if query_id != query:
                done += _ranked(query, heap)
                query, heap = query_id, []
            _push(heap, k, math.nan if score is None else score, vec_id)  # pandas has one for both
        if done:
            yield _rows(done, kind)
    if heap:
        yield _rows(_ranked(query, heap), kind)


def _ranked(query, heap) -> list[tuple]:
    best = sorted(heap, reverse=True)
    return [(query, rank, -minus, _score(*entry)) for rank, (*entry, minus) in enumerate(best, 1)]


def _rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int32(), kind, pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["query_id", "rank", "vec_id", "score"]
    )
