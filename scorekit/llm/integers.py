"""Vectors of numbers as vectors of integers, whose products and distances are exact."""

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# What a sum of products may reach for double precision to hold it, and sums of a few like it.
EXACT = 1 << 50
LONGEST = (1 << 63) - 1


def finite(vector: Column, scale: float) -> Column:
    """Vectors that are not null and whose components, times `scale`, are all finite numbers."""
    wrong = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) == float("inf")),
    )
    return F.coalesce(vector.isNotNull() & ~wrong, F.lit(False))


def rows_of(column: pa.Array) -> np.ndarray:
    """An Arrow column of vectors of one length as a matrix of doubles."""
    size = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(size, -1) if size else flat.reshape(0, 0)


def floors(vectors: np.ndarray, scale: float) -> np.ndarray:
    """`floor(scale * x)` of each component.

    The matrix is of doubles if all products of its rows and all squared distances stay below `EXACT`,
    so that they are exact whatever the order they are added in, and else of Python's integers.
    """
    values = np.floor(vectors * scale)
    most = float(np.abs(values).max(initial=0.0))
    if most < 2.0**25 and values.shape[1] * (2 * int(most)) ** 2 < EXACT:
        return values
    whole = np.empty(values.shape, object)
    whole[...] = [[int(x) for x in row] for row in values.tolist()]
    return whole


def alike(*matrices: np.ndarray) -> list[np.ndarray]:
    """The matrices, all of doubles or, if one is or would have to be, all of Python's integers."""
    most = max((int(np.abs(m).max(initial=0)) for m in matrices), default=0)
    if all(m.dtype != object for m in matrices) and matrices[0].shape[1] * (2 * most) ** 2 < EXACT:
        return list(matrices)
    return [m if m.dtype == object else exact_integers(m) for m in matrices]


def exact_integers(values: np.ndarray) -> np.ndarray:
    """Whole doubles as Python's integers."""
    whole = np.empty(values.size, object)
    whole[:] = [int(x) for x in values.ravel().tolist()]
    return whole.reshape(values.shape)


def roots_above(squares: np.ndarray) -> np.ndarray:
    """The least integers whose squares reach `squares`."""
    if squares.dtype == object:
        return np.array([isqrt(x - 1) + 1 if x > 0 else 0 for x in squares.ravel()], object).reshape(squares.shape)
    roots = np.ceil(np.sqrt(squares))
    return roots + (roots * roots < squares)


def roots_below(squares: np.ndarray) -> np.ndarray:
    """The largest integers whose squares do not exceed `squares`."""
    if squares.dtype == object:
        return np.array([isqrt(x) for x in squares.ravel()], object).reshape(squares.shape)
    roots = np.floor(np.sqrt(squares))
    return roots - (roots * roots > squares)


def longs(values: np.ndarray) -> pa.Array:
    """Integers as longs; what a long cannot hold becomes the one nearest to it."""
    if values.dtype == object:
        return pa.array([max(-LONGEST - 1, min(LONGEST, int(x))) for x in values], pa.int64())
    return pa.array(values.astype(np.int64))
