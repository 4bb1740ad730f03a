"""Approximate nearest neighbours over learned partitions.

On a bounded sample: the nearest-neighbour graph, cut into equal parts with few edges between them, and a small network
that learns which parts a vector's neighbours lie in. All rows then go to their most probable part. Queries go to their
several most probable parts, as many as reach the wanted recall on rows of the sample that took no part in learning, and
all rows there are ranked by their exact distances. Parts and queries meet in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import pick
from tapeline.llm.vectors import by_length, usable
from tapeline.session import staged

#: Rows, in expectation, of the sample that the partition and the network are fitted on: its bound.
SAMPLE = 8000
#: Recall of the routing to aim at; the rows of a sample lie apart farther than all rows, so more is reached.
RECALL = 0.97
GRAPH_NEIGHBOURS = 10
ROWS_PER_PART = 2500
PARTS = (4, 64)
#: Rows and queries of one group.
BLOCK, QUERIES = 4096, 4096


def neighbour_graph(x: np.ndarray, base: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Places in ``base`` of the k nearest rows to each row of ``x``; ``own``: x is base, and no row is its own neighbour."""
    out, norms = np.empty((len(x), k), np.int64), (base**2).sum(axis=1)
    for lo in range(0, len(x), 500):
        d = norms[None, :] - 2 * x[lo : lo + 500] @ base.T
        if own:
            d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        out[lo : lo + 500] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int, rounds: int = 30, slack: float = 0.05) -> np.ndarray:
    """Parts (a power of two) of about equal size with few graph edges between them.

    Halving along the main direction gives a start; then nodes move where most of their neighbours are, best gains
    first and half of them at a time, while no part leaves the allowed size.
    """
    rng, n = np.random.default_rng(seed), len(x)
    part = np.zeros(n, np.int64)
    while (k := part.max() + 1) < parts:
        halves = np.empty_like(part)
        for p in range(k):
            own = np.flatnonzero(part == p)
            centred = x[own] - x[own].mean(axis=0)
            axis = rng.normal(size=x.shape[1])
            for _ in range(10):
                axis = centred.T @ (centred @ axis)
                axis /= max(np.linalg.norm(axis), 1e-300)
            order = own[np.argsort(centred @ axis, kind="stable")]
            halves[order] = 2 * p + (np.arange(len(order)) >= len(order) // 2)
        part = halves
    most, least = math.ceil(n / parts * (1 + slack)), math.floor(n / parts * (1 - slack))
    a, b = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    a, b = np.concatenate((a, b)), np.concatenate((b, a))
    for _ in range(rounds):
        votes = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        size, moved = np.bincount(part, minlength=parts), 0
        order = np.argsort(-gain, kind="stable")
        for i in order[(gain[order] > 0) & (rng.random(n) < 0.5)]:
            if size[best[i]] < most and size[part[i]] > least:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i], moved = best[i], moved + 1
        if not moved:
            break
    return part


class Router:
    """A network with one hidden layer; its outputs rank the parts for a vector."""

    def __init__(self, x: np.ndarray, target: np.ndarray, seed: int, hidden: int = 128, epochs: int = 40, rate: float = 2e-3):
        rng = np.random.default_rng(seed)
        self.centre, self.scale = x.mean(axis=0), max(float(x.std()) * math.sqrt(x.shape[1]), 1e-300)
        x, d = (x - self.centre) / self.scale, x.shape[1]
        w = [rng.normal(size=(d, hidden)) * math.sqrt(2 / d), np.zeros(hidden), rng.normal(size=(hidden, target.shape[1])) * math.sqrt(1 / hidden), np.zeros(target.shape[1])]
        first, second, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), 256):
                batch = order[lo : lo + 256]
                z = x[batch] @ w[0] + w[1]
                a = np.maximum(z, 0)
                y = a @ w[2] + w[3]
                p = np.exp(y - y.max(axis=1, keepdims=True))
                g = (p / p.sum(axis=1, keepdims=True) - target[batch]) / len(batch)
                back = (g @ w[2].T) * (z > 0)
                step += 1
                for i, slope in enumerate((x[batch].T @ back, back.sum(axis=0), a.T @ g, g.sum(axis=0))):
                    first[i] = 0.9 * first[i] + 0.1 * slope
                    second[i] = 0.999 * second[i] + 0.001 * slope**2
                    w[i] = w[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        self.w = w

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts by falling probability for each row."""
        z = np.maximum((x - self.centre) / self.scale @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]
        return np.argsort(-z, axis=1, kind="stable")


def fit(sample: np.ndarray, parts: int, k: int, recall: float = RECALL, seed: int = 1) -> tuple[Router, int]:
    """A router for ``parts`` parts, and the number of parts to ask for ``recall`` of the k nearest."""
    sample = np.unique(sample, axis=0)
    sample = sample[np.random.default_rng(seed).permutation(len(sample))]
    tried = min(500, len(sample) // 5)
    x, tests = sample[tried:], sample[:tried]
    near = min(GRAPH_NEIGHBOURS, max(1, len(x) - 1))
    graph = neighbour_graph(x, x, near, True) if len(x) > 1 else np.zeros((len(x), 1), np.int64)
    part = balanced_parts(x, graph, parts, seed)
    around = np.concatenate((np.arange(len(x))[:, None], graph), axis=1)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), around.shape[1]), part[around].ravel()), 1 / around.shape[1])
    router = Router(x, target, seed)
    if not tried:
        return router, parts
    home = router.ranked(x)[:, 0]
    asked, true = router.ranked(tests), neighbour_graph(tests, x, min(k, len(x)), False)
    place = (asked[:, None, :] == home[true][:, :, None]).argmax(axis=2)
    found = [(place < p).mean() for p in range(1, parts + 1)]
    return router, next((p for p, f in enumerate(found, 1) if f >= recall), parts)


def _route(router: Router | None, probes: int):
    """Rows (id, v, part); vectors of other lengths than the sample's have a part of their own for each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, m in by_length(batch.column(1)):
                if router is not None and m.shape[1] == len(router.centre):
                    part = router.ranked(m)[:, :probes]
                else:
                    part = np.full((len(at), 1), -m.shape[1])
                rows = batch.take(pa.array(at))
                for p in part.T:
                    yield pa.record_batch([*rows.columns, pa.array(p, pa.int32())], ["id", "v", "part"])

    return run


def nearest_in(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, distance) of the k nearest rows with another id, ties to smaller ids. Exact in double precision."""
    x2, out = (x**2).sum(axis=1), []
    for lo in range(0, len(q), 256):
        b, b_id = q[lo : lo + 256], q_id[lo : lo + 256]
        both = (b**2).sum(axis=1)[:, None] + x2[None, :]
        d, room = both - 2 * b @ x.T, 1e-12 * both
        d[b_id[:, None] == x_id[None, :]] = np.inf
        kk = min(k, len(x)) - 1
        at_most = np.partition(d + room, kk, axis=1)[:, kk]
        for i in range(len(b)):
            c = np.flatnonzero((d[i] - room[i] <= at_most[i]) & np.isfinite(d[i]))
            exact = np.sqrt(((x[c] - b[i]) ** 2).sum(axis=1))
            c = c[order := np.lexsort((x_id[c], exact))[:k]]
            out.append((np.full(len(c), b_id[i]), x_id[c], exact[order]))
    return tuple(map(np.concatenate, zip(*out)))


def search(table: DataFrame, queries: DataFrame, k: int = 10, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found rows of ``table`` to each of ``queries`` (both vec_id, embedding).

    Score is the Euclidean distance. Rows with the query's id are its own and no candidates; equal rows are candidates each
    for itself; an id that occurs more than once among the queries is searched once. Rows with a null id, and vectors that are
    null, zero or empty or hold null or non-finite components, take no part; vectors of different lengths are not compared.
    Empty tables give an empty one; other columns are ignored.
    """
    clean = lambda t: pick(t, "vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = clean(table)
    asked = clean(queries).groupBy("id").agg(F.min_by("v", F.xxhash64("v")).alias("v"))
    n = rows.count()
    drawn = F.pmod(F.xxhash64(F.lit(23), "id", "v"), F.lit(1 << 30)) < int(min(1.0, sample / max(n, 1)) * (1 << 30))
    got = rows.where(drawn).select("v").toArrow().column("v")
    router, probes = None, 1
    if len(got) > 1:
        m = max(by_length(got), key=lambda x: len(x[0]))[1]
        parts = min(PARTS[1], max(PARTS[0], 2 ** round(math.log2(max(n, 1) / ROWS_PER_PART))))
        if len(m) >= 8 * parts:
            router, probes = fit(m[np.lexsort(m.T)], parts, k, recall)
    kinds = "id bigint, v array<double>, part int"
    index = staged(rows.mapInArrow(_route(router, 1), kinds), "ann-index")
    routed = staged(asked.mapInArrow(_route(router, probes), kinds), "ann-queries")
    pieces = lambda t, size, name: t.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    # a row for each part: at most PARTS and one for each other length of vector
    grid = pieces(index, BLOCK, "blocks").join(pieces(routed, QUERIES, "chunks"), "part")
    grid = F.broadcast(staged(grid, "ann-grid"))
    block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.col("blocks"))
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks"))
    left = index.join(grid, "part").select("id", "v", "part", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    right = routed.join(grid, "part").select("id", "v", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), chunk.alias("chunk"))

    def meet(cell: pa.Table, ask: pa.Table) -> pa.Table:
        if not cell.num_rows or not ask.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        (_, x), (_, q) = by_length(cell.column("v"))[0], by_length(ask.column("v"))[0]
        query, near, d = nearest_in(q, ask.column("id").to_numpy(), x, cell.column("id").to_numpy(), k)
        return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(near, pa.int64()), "score": pa.array(d, pa.float64())})

    cell = ["part", "block", "chunk"]
    left = left.select("id", "v", "part", F.col("block").cast("int").alias("block"), "chunk")
    right = right.select("id", "v", "part", "block", F.col("chunk").cast("int").alias("chunk"))
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(meet, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
