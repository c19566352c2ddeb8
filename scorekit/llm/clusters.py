"""Centroid clustering in exact integers, by a vantage-point tree over the centroids.

Each round builds a tree over the centroids and broadcasts it. A node of the tree holds one centroid, the
vantage point, and parts the others into a near and a far half by their distance from it. A vector
looks into the tree best first: of the parts that are open it takes the one that may hold the nearest
centroid yet. How near a part can come follows from the vector's distance to the vantage point and
from the least and the greatest distance of the part's centroids to it; the bound is rounded down to an
integer, and a part is left out only if its bound is above the best distance found, so that equal
distances are all seen and the smaller number wins. All vectors of a batch walk at the same time.

The sums of the vectors of each centroid are made in each task, as exact integers.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.llm.common import checkpoint
from scorekit.llm.integers import (
    LONGEST,
    alike,
    exact_integers,
    finite,
    floors,
    longs,
    roots_above,
    roots_below,
    rows_of,
)

SCALE = 256.0
SEED = 2
CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64

# Centroids in a leaf of a tree, and vectors that walk it together.
LEAF = 4
BATCH = 8192

# A sum goes to Spark in limbs of so many bits, of which any number of tasks add up in a long.
LIMB = 32


@dataclass(frozen=True)
class Node:
    """Some centroids: those of a leaf, or a vantage point alone with its two parts."""

    numbers: np.ndarray
    parts: tuple[tuple[int, int, int], ...] = ()
    """Of each part its node and the bounds, rounded outwards, of its distances from the vantage point."""


def build_tree(centroids: np.ndarray) -> list[Node]:
    """The nodes of a vantage-point tree over the rows of `centroids`; the first one is the root."""
    nodes: list[Node | None] = []

    def grow(numbers: np.ndarray) -> int:
        own = len(nodes)
        nodes.append(None)
        if len(numbers) <= LEAF:
            nodes[own] = Node(numbers)
            return own
        squares = _squares(centroids[numbers], centroids[numbers])
        # The centroid whose distances to the others differ most parts them best.
        spread = [int(roots.max()) - int(roots.min()) for roots in map(roots_below, squares)]
        at = spread.index(max(spread))
        rest = np.delete(np.arange(len(numbers)), at)
        rest = rest[np.argsort(squares[at, rest], kind="stable")]
        parts = []
        for half in (rest[: len(rest) // 2], rest[len(rest) // 2 :]):
            low, high = squares[at, half].min(), squares[at, half].max()
            bounds = roots_below(np.array([low], squares.dtype))[0], roots_above(np.array([high], squares.dtype))[0]
            parts.append((grow(np.sort(numbers[half])), *map(int, bounds)))
        nodes[own] = Node(numbers[[at]], tuple(parts))
        return own

    grow(np.arange(len(centroids)))
    return nodes


def nearest_centroids(
    vectors: np.ndarray, centroids: np.ndarray, tree: list[Node]
) -> tuple[np.ndarray, np.ndarray]:
    """For each row of `vectors` the number of the nearest centroid and its squared distance."""
    vectors, centroids = alike(vectors, centroids)
    count = len(vectors)
    number = np.full(count, -1)
    distance = np.full(count, np.inf) if vectors.dtype != object else np.full(count, None, object)
    # The least distance at which each open part may hold a centroid; what is not open is at infinity.
    reach = np.full((count, len(tree)), np.inf)
    reach[:, 0] = 0
    walking = np.arange(count)
    while len(walking):
        first = reach[walking].argmin(axis=1)
        nearest = reach[walking, first]
        on = (nearest < np.inf) & ((number[walking] < 0) | (nearest <= _root(distance[walking])))
        walking, first = walking[on], first[on]
        for i in np.unique(first).tolist():
            rows = walking[first == i]
            node = tree[i]
            reach[rows, i] = np.inf
            squares = _squares(vectors[rows], centroids[node.numbers])
            at = squares.argmin(axis=1)  # the first, and numbers rise
            least, named = squares[np.arange(len(rows)), at], node.numbers[at]
            known = number[rows] >= 0
            better = ~known
            better[known] = (least[known] < distance[rows[known]]) | (
                (least[known] == distance[rows[known]]) & (named[known] < number[rows[known]])
            )
            number[rows[better]], distance[rows[better]] = named[better], least[better]
            if node.parts:
                low, high = roots_below(squares[:, 0]), roots_above(squares[:, 0])
                for part, least_of, most_of in node.parts:
                    bound = np.maximum(np.maximum(low - most_of, least_of - high), 0)
                    reach[rows, part] = _rounded_down(bound)
    return number, distance


def _root(squares: np.ndarray) -> np.ndarray:
    """Roots as doubles, none below the true one."""
    if squares.dtype != object:
        return roots_above(squares)
    known = np.array([0 if s is None else s for s in squares], object)
    return np.nextafter(_doubles(roots_above(known)), np.inf)


def _rounded_down(values: np.ndarray) -> np.ndarray:
    if values.dtype != object:
        return values
    return np.maximum(np.nextafter(_doubles(values), -np.inf), 0)


def _doubles(values: np.ndarray) -> np.ndarray:
    """The doubles next to integers, infinity for those beyond all doubles."""
    most = int(np.finfo(float).max)
    return np.array([float(x) if x <= most else np.inf for x in values])


def _squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of `left` to all of `right`, exact."""
    return (left * left).sum(axis=1)[:, None] - 2 * (left @ right.T) + (right * right).sum(axis=1)[None, :]


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: float = SCALE,
    seed: int = SEED,
    vector: str = "embedding",
    key: str = "vec_id",
) -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256` of the vectors that are kept.

    Kept are vectors with exactly `dimensions` components of which none is null or not finite; a
    component x counts as `floor(scale * x)`. The first centroids are the kept vectors whose keys have
    the smallest hashes, of equal keys those that are smaller, vectors without a key last; fewer vectors
    than `clusters` make fewer centroids. Every row is a vector of its own, whether or not another repeats
    its key or its components; a centroid that no vector is nearest to stays. Further columns are not
    looked at, and an empty table gives an empty result.

    Centroids, sums and assignments are exact for numbers of any size; a distance or an inertia that a
    long cannot hold is given as the largest long. Each round scans the vectors once and shuffles sums
    only; what comes to the driver are the centroids. The assignment is written to the shared checkpoint
    folder, without the vectors.
    """
    spark = vectors.sparkSession
    kept = vectors.where(finite(F.col(vector), scale) & (F.size(vector) == dimensions)).select(
        F.col(key).alias("vec_id"), F.col(vector).alias("vector")
    )
    centroids = _first_centroids(kept, clusters, dimensions, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(spark, kept, centroids, scale)
    shared = spark.sparkContext.broadcast((centroids, build_tree(centroids)))
    kind = dict(kept.dtypes)["vec_id"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, number, distance, _ in _assigned(batches, *shared.value, scale):
            columns = [batch.column("vec_id"), pa.array(number, pa.int32()), longs(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    found = checkpoint(kept.mapInArrow(assign, f"vec_id {kind}, cluster int, distance bigint"))
    shared.unpersist()
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    of_each = found.groupBy("cluster").agg(total.alias("sum")).collect()  # a row for each centroid
    limit = [min(LONGEST, int(r["sum"])) for r in of_each]
    overall = min(LONGEST, sum(int(r["sum"]) for r in of_each))
    named = [
        (r["cluster"], inertia, overall, ",".join(str(int(x)) for x in centroids[r["cluster"]]))
        for r, inertia in zip(of_each, limit)
    ]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia bigint, inertia bigint, components string")
    facts = facts.withColumn("centroid_sha256", F.sha2("components", 256)).drop("components")
    joined = found.join(F.broadcast(facts), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _first_centroids(
    kept: DataFrame, clusters: int, dimensions: int, scale: float, seed: int
) -> np.ndarray:
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = kept.orderBy(name.asc_nulls_last(), "vec_id", "vector").limit(clusters).select("vector").collect()
    values = np.array([r["vector"] for r in chosen], np.float64)
    return floors(values.reshape(len(chosen), dimensions), scale)


def _moved(spark: SparkSession, kept: DataFrame, centroids: np.ndarray, scale: float) -> np.ndarray:
    """The centroids after one round."""
    shared = spark.sparkContext.broadcast((centroids, build_tree(centroids)))
    count, dimensions = centroids.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(count, np.int64)
        sums = np.zeros((count, dimensions), object)
        for _, number, _, values in _assigned(batches, *shared.value, scale):
            order = np.argsort(number, kind="stable")
            named, starts = np.unique(number[order], return_index=True)
            added = np.add.reduceat(values[order], starts, axis=0)
            sizes[named] += np.diff(np.append(starts, len(number)))
            # A batch's sums of doubles are exact: `BATCH` times a component is below 2 ** 53.
            sums[named] += added if added.dtype == object else exact_integers(added)
        if sizes.any():
            yield _limbs(sizes, sums)

    parts = kept.select("vector").mapInArrow(add_up, "cluster int, place int, limb int, value bigint")
    totals = parts.groupBy("cluster", "place", "limb").agg(F.sum("value").alias("value"))
    # A few limbs for each component of each centroid.
    return _means(totals.collect(), centroids)


def _assigned(batches, centroids, tree, scale):
    """Of each part of the batches: itself, the numbers, the squared distances, and the integers."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            part = batch.slice(start, BATCH)
            values = floors(rows_of(part.column("vector")), scale)
            yield part, *nearest_centroids(values, centroids, tree), values


def _limbs(sizes: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """Sums and, at the place after the last component, sizes, in limbs that are not zero."""
    rows = []
    for c in np.flatnonzero(sizes).tolist():
        for place, total in enumerate([*sums[c], int(sizes[c])]):
            total, limb = int(total), 0
            while total:
                low = total & ((1 << LIMB) - 1)
                if -(1 << LIMB) < total < 0:
                    low = total  # the last limb has the sign
                rows.append((c, place, limb, low))
                total, limb = (total - low) >> LIMB, limb + 1
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["cluster", "place", "limb", "value"])


def _means(totals: list, centroids: np.ndarray) -> np.ndarray:
    count, dimensions = centroids.shape
    sums = np.zeros((count, dimensions + 1), object)
    for cluster, place, limb, value in totals:
        sums[cluster, place] += int(value) << (LIMB * limb)
    moved = exact_integers(centroids) if centroids.dtype != object else centroids.copy()
    for c in range(count):
        if size := sums[c, dimensions]:
            moved[c] = [total // size for total in sums[c, :dimensions]]
    small = int(np.abs(moved).max(initial=0)) < 1 << 25
    return alike(moved.astype(float))[0] if small else moved
