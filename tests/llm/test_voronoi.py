import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tapeline.llm import voronoi as V

SCHEMA = "vec_id bigint, embedding array<double>"


def plain(rows, queries, k, scale=1024):
    whole = lambda v: None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(scale * x) for x in v]
    data = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = []
    for i, q in {i: whole(v) for i, v in queries if i is not None and whole(v) is not None}.items():
        scores = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in data if j != i and len(x) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def clustered(rng, n, d, spread):
    centres = rng.normal(size=(8, d))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    return [(k, (centres[rng.integers(8)] + spread * rng.normal(size=d)).tolist()) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_odd_rows_against_all_pairs(spark):
    rng = random.Random(1)
    rows = [(k, [rng.randint(-3, 3) / 2 for _ in range(3)]) for k in range(120)]
    rows += [(k, [0.5, 0.5, 0.5]) for k in range(200, 260)]  # one vector many times
    rows += [(300, [1.5, 1.5, 1.5])] * 15 + [(301, [0.0, 0.0, 0.0]), (302, None), (303, [1.0, None, 2.0]), (304, [float("nan")] * 3), (305, [float("inf"), 0.0, 0.0]), (None, [9.0, 9.0, 9.0])]
    rows += [(400, []), (401, []), (410, [1.0, 2.0]), (411, [2.0, 1.0]), (412, [0.3, 0.1, -7.0]), (413, [1e-9, -1e-9, 0.0])]
    rows += [(500, [1.0, 1.0, k / 10]) for k in range(14)]  # one id, many vectors
    queries = [r for r in rows if r[0] is not None and r[0] != 500 and r[0] % 3 == 0 or r[0] in (301, 400, 401, 410)]
    extra = frame(spark, rows).selectExpr("vec_id", "embedding", "1 AS a", "'x' AS b").toDF("vec_id", "embedding", "VEC_ID", "Embedding")
    for size in ({"group": 7, "slice_numbers": 90}, {}):
        assert found(V.search(extra, frame(spark, queries), 10, **size)) == plain(rows, queries, 10)


def test_queries_with_many_vectors_of_their_own_id(spark):
    rows = [(1, [1.0, k / 16]) for k in range(40)] + [(2 + k, [0.5, k / 16]) for k in range(30)]
    queries = [(1, [1.0, 0.5])]
    assert found(V.search(frame(spark, rows), frame(spark, queries), 5, pivots=(4, 4))) == plain(rows, queries, 5)


def test_clusters_are_searched_without_sending_all_rows(spark):
    rows = clustered(np.random.default_rng(2), 1500, 6, 0.02)
    queries = [r for r in rows if r[0] % 50 == 0]
    want = plain(rows, queries, 10)
    for group in (4, 4096):
        assert found(V.search(frame(spark, rows), frame(spark, queries), 10, group=group, slice_numbers=900)) == want
    plan = V.Plan(frame(spark, rows), frame(spark, queries), 10, 1024, 4, (64, 64))
    groups = plan.asked.select("grp").distinct().count()
    assert plan.sent().count() < 0.5 * groups * len(rows)
    assert plan.sent(10).count() == plan.sent().count()  # salts change no row


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 4), st.floats(0.01, 2))
def test_reach_holds_the_nearest(seed, d, spread):
    rng = np.random.default_rng(seed)
    x = np.floor(1024 * np.array([v for _, v in clustered(rng, 40, d, spread)])).astype(np.int64)
    cells = V.Cells(np.unique(x[:6], axis=0), float(np.sqrt((x.astype(float) ** 2).sum(axis=1)).max()))
    cell, far = cells.assign(x, False)
    home, off = cells.assign(x[:5], True)
    k, nearest = 3, []
    for c in np.unique(cell):
        nearest += [(int(c), int(i), float(far[i])) for i in np.flatnonzero(cell == c)[np.argsort(far[cell == c])][: k + 1]]
    for q in range(5):
        least, most = V.reach(cells, nearest, int(home[q]), float(off[q]), k)
        scores = sorted((-int(x[q] @ x[i]), i) for i in range(len(x)) if i != q)
        for _, i in [s for s in scores if s[0] <= scores[k - 1][0]]:
            assert least[cell[i]] <= far[i] <= most[cell[i]]


def test_sums_beyond_doubles_are_exact():
    q, x = np.array([[1 << 40, 3]]), np.array([[1 << 40, 1], [1 << 40, 2], [-(1 << 62), 0]])
    assert V.largest_in(q, np.array([9]), x, np.array([1, 2, 3]), 3) == [(9, 2, (1 << 63) - 1), (9, 1, (1 << 63) - 1), (9, 3, -(1 << 63))]
    assert V.products(np.array([[1 << 30, 1]]), np.array([[1 << 30, 1]])).tolist() == [[(1 << 60) + 1]]


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], SCHEMA), frame(spark, [(1, [1.0]), (2, [2.0])])
    assert V.search(none, some).count() == 0 and V.search(some, none).count() == 0
    assert found(V.search(some, some)) == [(1, 1, 2, 2048 * 1024), (2, 1, 1, 2048 * 1024)]
