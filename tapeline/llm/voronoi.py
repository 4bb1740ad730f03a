"""Exact search for the largest inner products: a k nearest neighbour join over Voronoi cells.

One more component makes the search one by distance: a row x gets sqrt(M^2 - |x|^2), M the largest norm, and a query q
gets 0, so that |q - x|^2 = M^2 + |q|^2 - 2 qx. Pivots, drawn from the rows, cut rows and queries into cells. A group of
queries knows how far its members lie from their pivot, and each cell of rows how many it has and the least distances from
its own; by the triangle inequality these summaries bound how far the k nearest of any query in the group can be, and
from which distance to its pivot on a row of a cell can be among them. Only such rows are sent to the group. Groups and
slices of cells have a bounded number of rows, are solved exactly in integers, and the slices' results merge.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import bound_batches, pick
from tapeline.session import staged

SCALE = 1024
#: Pivots are as many as the square root of the number of rows, between these. They decide how finely rows are left out, never
#: what is found; every task holds them, hence the upper bound.
PIVOTS = (16, 2048)
#: Numbers (rows times components) of a slice of rows, and queries of a group.
SLICE, GROUP = 1 << 20, 4096
#: What rounding may add to or take from a distance, in units of M: a square root turns 1e-14 into 1e-7.
ROOM = 1e-6


def quantized(table: DataFrame, scale: int) -> DataFrame:
    """(id, v) of the rows that take part; v: the vector's components times ``scale``, rounded down to whole numbers."""
    rows = pick(table, "vec_id", "embedding").select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
    return rows.select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))


def by_length(column: pa.Array | pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, whole-number matrix) of the vectors of each length; empty vectors have a matrix without columns."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, size = column.flatten().to_numpy(), column.value_lengths().to_numpy().astype(np.int64)
    start = np.cumsum(size) - size
    places = [np.flatnonzero(size == d) for d in np.unique(size)]
    return [(at, flat[start[at][:, None] + np.arange(size[at[0]])]) for at in places]


def along(points: np.ndarray) -> np.ndarray:
    """An order of the points in which neighbours are near each other: halves along the widest direction, again and again."""
    if len(points) < 3:
        return np.arange(len(points))
    centred = points - points.mean(axis=0)
    order = np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")
    return np.concatenate([half[along(points[half])] for half in np.array_split(order, 2)])


class Cells:
    """The pivots, for vectors of their length; everything is in units of ``norm``, the largest norm of a row."""

    def __init__(self, pivots: np.ndarray, norm: float):
        self.norm, self.length = norm or 1.0, pivots.shape[1]
        points = self.lifted(pivots)
        self.points = points[along(points)]
        self.squares = (self.points**2).sum(axis=1)

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        x = x.astype(np.float64) / self.norm
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(1 - (x**2).sum(axis=1), 0))
        return np.concatenate((x, last[:, None]), axis=1)

    def assign(self, x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each vector and the distance from it."""
        y = self.lifted(x, query)
        cell = np.concatenate([(self.squares[None, :] - 2 * y[lo : lo + 1024] @ self.points.T).argmin(axis=1) for lo in range(0, len(y), 1024)])
        return cell, np.sqrt(((y - self.points[cell]) ** 2).sum(axis=1))


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _assign(cells: Cells | None, query: bool) -> Batches:
    """Adds length, cell (-1 where the vector's length is not the pivots') and distance from the pivot; v is the second column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in by_length(batch.column(1)):
                if cells is not None and x.shape[1] == cells.length:
                    cell, far = cells.assign(x, query)
                else:
                    cell, far = np.full(len(at), -1), np.zeros(len(at))
                rows = batch.take(pa.array(at))
                added = [pa.array(np.full(len(at), x.shape[1]), pa.int32()), pa.array(cell, pa.int32()), pa.array(far)]
                yield pa.record_batch([*rows.columns, *added], [*rows.schema.names, "d", "cell", "far"])

    return run


def reach(cells: Cells, nearest: list[tuple[int, int, float]], cell: int, radius: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance from its pivot, for each cell, of the rows that can be among the k nearest of a query.

    The query lies within ``radius`` of the pivot of ``cell``. ``nearest`` holds (cell, id, distance) of the k + 1 ids
    nearest to each pivot; one of these ids may be the query's own.
    """
    apart = np.sqrt(((cells.points - cells.points[cell]) ** 2).sum(axis=1))
    ids, at_most = set(), np.inf
    for bound, i in sorted((radius + apart[c] + far, i) for c, i, far in nearest):
        ids.add(i)
        if len(ids) > k:
            at_most = bound
            break
    return apart - radius - at_most - ROOM, apart + radius + at_most + ROOM


def _reaches(cells: Cells | None, nearest: list[tuple[int, int, float]], k: int) -> Batches:
    """From (d, grp, cell, radius) to (d, grp, cell of rows, least, most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] < 0:
                    to, least, most = np.array([-1]), np.array([-np.inf]), np.array([np.inf])
                else:
                    least, most = reach(cells, nearest, row["cell"], row["radius"], k)
                    to = np.arange(len(least))
                same = [pa.array([row[c]] * len(to), t) for c, t in (("d", pa.int32()), ("grp", pa.int64()))]
                yield pa.record_batch([*same, pa.array(to, pa.int32()), pa.array(least), pa.array(most)], ["d", "grp", "cell", "least", "most"])

    return run


FOUND = "query_id bigint, vec_id bigint, score bigint"
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole-number vectors: as doubles where these hold every sum exactly, else as Python's numbers."""
    largest = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
    if largest(q) * largest(x) * max(q.shape[1], 1) < 1 << 53:
        return q.astype(np.float64) @ x.astype(np.float64).T
    return np.array([[sum(a * b for a, b in zip(r, s)) for s in x.tolist()] for r in q.tolist()], dtype=object).reshape(len(q), len(x))


def largest_in(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, id, score) of the k largest products of each query with rows of other ids, ties to smaller ids."""
    out, step = [], max(1, (1 << 22) // max(len(x), 1))
    for lo in range(0, len(q), step):
        for i, s in zip(q_id[lo : lo + step], products(q[lo : lo + step], x)):
            other = np.flatnonzero(x_id != i)
            s = s[other]
            if len(s) > k:
                enough = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                s, other = s[enough], other[enough]
            order = sorted(zip((-s).tolist(), x_id[other].tolist()))[:k]
            out += [(int(i), at, min(max(int(-score), _LEAST), _MOST)) for score, at in order]
    return out


def _solve(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(rows: pa.Table, ask: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if rows.num_rows and ask.num_rows:
            (_, x), (_, q) = by_length(rows.column("v"))[0], by_length(ask.column("v"))[0]
            copies = rows.column("copies").to_numpy()
            out = largest_in(q, ask.column("id").to_numpy(), np.repeat(x, copies, axis=0), np.repeat(rows.column("id").to_numpy(), copies), k)
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 3, [c.split()[0] for c in FOUND.split(", ")])

    return run


def _norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, x in by_length(batch.column(0)):
            norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)).max()
            yield pa.record_batch([pa.array([x.shape[1]], pa.int32()), pa.array([len(at)], pa.int64()), pa.array([norm])], ["d", "n", "norm"])


class Plan:
    """Rows and queries in their cells, and which rows each group of queries needs."""

    def __init__(self, table: DataFrame, queries: DataFrame, k: int, scale: int, group: int, pivots: tuple[int, int]):
        # of equal vectors only the k + 1 smallest ids can be among a query's k, its own left out; of one id k copies
        rows = quantized(table, scale).groupBy("v", "id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies"))
        place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
        rows = staged(rows.withColumn("_at", place).where(F.col("_at") <= k + 1).select("id", "v", "copies"), "voronoi-rows")
        asked = quantized(queries, scale).groupBy("id").agg(F.min_by("v", F.xxhash64("v")).alias("v"))
        lengths = rows.select("v").mapInArrow(_norms, "d int, n bigint, norm double").groupBy("d").agg(F.sum("n").alias("n"), F.max("norm").alias("norm"))
        most = lengths.orderBy(F.col("n").desc(), "d").first()
        self.cells, nearest = None, []
        if most is not None and most["d"] > 0:
            number = min(max(int(most["n"] ** 0.5), pivots[0]), pivots[1])
            drawn = rows.where(F.size("v") == most["d"]).orderBy(F.xxhash64(F.lit(5), "id", "v"), "id", "v").select("v").limit(number)
            self.cells = Cells(by_length(drawn.toArrow().column("v"))[0][1], most["norm"])
        kinds = "d int, cell int, far double"
        self.rows = staged(bound_batches(rows).mapInArrow(_assign(self.cells, False), "id bigint, v array<bigint>, copies int, " + kinds), "voronoi-index")
        asked = staged(bound_batches(asked).mapInArrow(_assign(self.cells, True), "id bigint, v array<bigint>, " + kinds), "voronoi-queries")
        if self.cells is not None:
            near = self.rows.where(F.col("cell") >= 0).groupBy("cell", "id").agg(F.min("far").alias("far"))
            near = near.withColumn("_at", F.row_number().over(Window.partitionBy("cell").orderBy("far", "id"))).where(F.col("_at") <= k + 1)
            nearest = [tuple(r) for r in near.select("cell", "id", "far").collect()]  # k + 1 rows for each pivot
        # groups follow the order of the pivots; a cell with more queries than a group is cut by a hash
        starts = asked.groupBy("d", "cell").agg(F.count(F.lit(1)).alias("n"))
        starts = starts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("d").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        grp = F.floor((F.col("before") + F.pmod(F.xxhash64("id"), F.col("n"))) / group).alias("grp")
        self.asked = asked.join(starts, ["d", "cell"]).select("id", "v", "d", "cell", "far", grp)
        radii = self.asked.groupBy("d", "grp", "cell").agg(F.max("far").alias("radius"))
        needs = radii.mapInArrow(_reaches(self.cells, nearest, k), "d int, grp bigint, cell int, least double, most double")
        self.needs = staged(needs.groupBy("d", "grp", "cell").agg(F.min("least").alias("least"), F.max("most").alias("most")), "voronoi-needs")

    def sent(self, salt_rows: int = 1 << 17) -> DataFrame:
        """The rows that each group needs, once for each group. Cells are salted, so a cell with many rows is many tasks' work."""
        salts = self.rows.groupBy("d", "cell").agg(F.ceil(F.count(F.lit(1)) / salt_rows).alias("salts"))
        rows = self.rows.join(salts, ["d", "cell"]).withColumn("salt", F.pmod(F.xxhash64("id", "v"), F.col("salts"))).drop("salts")
        needs = self.needs.join(salts, ["d", "cell"]).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
        return rows.join(needs, ["d", "cell", "salt"]).where(F.col("far").between(F.col("least"), F.col("most"))).select("d", "grp", "id", "v", "copies")


def search(table: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE, group: int = GROUP, slice_numbers: int = SLICE, pivots: tuple[int, int] = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``table`` with the largest scores for each of ``queries`` (both vec_id, embedding).

    Components count as floor(scale * x); the score is the integer inner product, ties go to the smaller vec_id. Rows with the
    query's id are its own and no candidates; repeated rows are candidates each for itself; an id that occurs more than once among the
    queries is searched once. Rows with a null id, and vectors that are null or hold null or non-finite components, take no part; zero
    vectors do. Vectors of different lengths are not compared; those without components score 0 with each other. Components and scores
    beyond 64 bits are held at the ends of that range, after ranking. Empty tables give an empty one; other columns are ignored.
    """
    plan = Plan(table, queries, k, scale, group, pivots)
    slices = plan.rows.groupBy("d").agg(F.ceil(F.count(F.lit(1)) * F.greatest("d", F.lit(1)) / slice_numbers).alias("slices"))
    part = F.pmod(F.xxhash64("v", "id"), F.col("slices")).alias("slice")
    left = plan.sent().join(slices, "d").select("d", "grp", part, "id", "v", "copies")
    right = plan.asked.join(slices, "d").select("d", "grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"), "id", "v")
    key = ["d", "grp", "slice"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_solve(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
