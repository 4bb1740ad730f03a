"""Connected components of a graph given by its edges, by alternating large and small stars.

Each partition first contracts its own edges to stars. Then, until nothing changes, every node sends its larger neighbours
to the smallest node it knows, and after that itself and its smaller neighbours. Edges of a node are never gathered: minima
are combined before they are shuffled and joined back to the edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.session import staged


def star_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the graph with edges a-b, for nodes that are not the least."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], least)
        np.minimum.at(new, root[y], least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while (root[root] != root).any():
        root = root[root]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        a, b = star_forest(np.concatenate((a, batch.column(0).to_numpy())), np.concatenate((b, batch.column(1).to_numpy())))
    for lo in range(0, len(a), 50_000):
        yield pa.record_batch([pa.array(a[lo : lo + 50_000]), pa.array(b[lo : lo + 50_000])], ["a", "b"])


def _toward_least(edges: DataFrame, label: str) -> DataFrame:
    """One large and one small star of edges (a, b), b < a."""
    both = edges.union(edges.select("b", "a"))
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), label)
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    large = staged(large, label)
    least = staged(large.groupBy("a").agg(F.min("b").alias("m")), label)
    small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return staged(small.union(least).where("a <> b").distinct(), label)


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) with the least node of its component for every node of ``edges`` (two bigint columns) but the roots."""
    a, b = edges.columns
    plain = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b")
    stars = staged(plain.mapInArrow(_contract, "a bigint, b bigint").distinct(), label)
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    seen = mark(stars)
    while seen[0]:
        stars = _toward_least(stars, label)
        if (now := mark(stars)) == seen:
            break
        seen = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
