"""What the operators on embeddings share."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """Whether a vector can be compared: not null, not zero, and every component a finite number."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


@lru_cache(64)
def rotation(dimension: int, seed: int, number: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dimension, number]).normal(size=(dimension, dimension)))
    return q * np.sign(np.diag(r))


def by_length(column: pa.Array | pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix in double precision) of the vectors of each length in a list column without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(size) - size
    return [(at, flat[(start[at][:, None] + np.arange(d))]) for d in np.unique(size) if len(at := np.flatnonzero(size == d))]


def unit(m: np.ndarray) -> np.ndarray:
    big = np.abs(m).max(axis=1, keepdims=True)
    m = m / np.where(big > 0, big, 1)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
