import math

import numpy as np
import pandas as pd

from tapeline.llm import components as C
from tapeline.llm import neighbours, vector_dedup

KIND = "vec_id bigint, embedding array<float>, label int"


def odd_vectors(n=400, d=16, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.normal(size=d)
        rows.append((i, v.astype(np.float32).tolist(), 1))
        if i % 10 == 0:
            rows += [(1000 + 10 * i + k, (v + rng.normal(size=d) * 0.08 * k).astype(np.float32).tolist(), 1) for k in range(4)]
    hot = rows[3][1]
    rows += [(9000 + k, hot, 2) for k in range(60)]
    rows += [(9100, None, 1), (9200, [0.0] * d, 1), (9300, [float("nan")] * d, 1), (9400, [float("inf")] + [1.0] * (d - 1), 1), (9500, [None] + [1.0] * (d - 1), 1), (9600, [], 1)]
    rows += [(9700, [1.0, 2.0], 1), (9800, [2.0, 4.0], 1), (None, rows[5][1], 1), (7, rows[9][1], 1)]  # two vectors of one id
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], KIND + ", c string").toDF("vec_id", "embedding", "label", "VEC_ID")


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_links_against_brute_force(spark):
    rows = odd_vectors()
    got = vector_dedup.near_vectors(table(spark, rows)).toPandas()
    assert len(got) == len(rows)
    good = [r for r in rows if usable(r[1])]
    links, a, b = [0] * len(good), [], []
    for i, (_, v, _) in enumerate(good):
        for j, (_, w, _) in enumerate(good):
            if i != j and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                    links[i] += 1
                    a.append(i)
                    b.append(j)
    node, root = C.star_forest(np.array(a), np.array(b))
    group = np.arange(len(good))
    group[node] = root
    least = pd.DataFrame({"g": group, "id": [r[0] for r in good]}).groupby("g").id.min()
    want = sorted((-1 if r[0] is None else r[0], n, int(least[g])) for r, n, g in zip(good, links, group))
    want += [(r[0], 0, r[0]) for r in rows if not usable(r[1])]
    have = [(-1 if pd.isna(r.vec_id) else int(r.vec_id), r.n_links, int(r.component_id)) for r in got.itertuples()]
    assert sorted(have) == sorted(want)
    assert (got.kept == (got.vec_id == got.component_id)).all()


def test_bound_is_certain():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 24))
    y = x + rng.normal(size=x.shape) * 0.07
    x, y = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (x, y))
    near = (x * y).sum(axis=1) >= 0.95
    (px, fx, _), (py, _, ey) = vector_dedup.codes(x), vector_dedup.codes(y)
    sign, rounded = vector_dedup.decoded(px, 24)[0], vector_dedup.decoded(py, 24)[1]
    dot = (sign * rounded).sum(axis=1)
    bound = np.cos(np.arccos(np.clip(fx, 0, 1)) + math.acos(0.95)) - 1e-4
    assert near.sum() > 500 and (dot[near] + ey[near] >= bound[near]).all()
    # the estimate has no bias over rotations of unrelated pairs
    other = rng.permutation(len(y))
    assert abs(((sign * rounded[other]).sum(axis=1) / fx - (x * y[other]).sum(axis=1)).mean()) < 0.01


def test_empty_and_tiny_tables(spark):
    none = spark.createDataFrame([], KIND)
    assert vector_dedup.near_vectors(none).count() == 0 and neighbours.search(none, none).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1)], KIND)
    assert [(r.query_id, r.vec_id) for r in neighbours.search(two, two.where("vec_id = 0")).collect()] == [(0, 1)]


def test_neighbours_of_odd_rows(spark):
    rows = odd_vectors()
    t = table(spark, rows)
    got = neighbours.search(t, t.where(t["label"] < 9), k=5).toPandas()
    good = [r for r in rows if usable(r[1]) and r[0] is not None]
    hit = total = 0
    for q, own in got.groupby("query_id"):
        own = own.sort_values("rank")
        v = np.array(next(r[1] for r in good if r[0] == q), float)
        ids = np.array([r[0] for r in good if r[0] != q and len(r[1]) == len(v)])
        d = np.array([np.sqrt(((np.array(r[1], float) - v) ** 2).sum()) for r in good if r[0] != q and len(r[1]) == len(v)])
        best = ids[np.lexsort((ids, d))[:5]]
        hit, total = hit + len(set(best) & set(own.vec_id)), total + len(best)
        assert own["rank"].tolist() == list(range(1, len(own) + 1)) and own.score.is_monotonic_increasing
        assert all(np.abs(d[ids == i] - s).min() < 1e-9 for i, s in zip(own.vec_id, own.score))
    assert got.query_id.nunique() == len({r[0] for r in good}) and hit / total >= 0.9


def test_recall_on_the_given_table(spark, sf_dir):
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.search(t, t.where("vec_id % 100 = 0"), sample=1500).toPandas()
    e = t.toPandas()
    x, ids = np.stack(e.embedding).astype(float), e.vec_id.to_numpy()
    hit = 0
    for q, own in got.groupby("query_id"):
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        hit += len(set(ids[np.lexsort((ids, d))[:10]]) & set(own.vec_id))
    assert hit / (10 * got.query_id.nunique()) >= 0.9


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(200, 8)) + 6 * rng.normal(size=8) for _ in range(8)])
    graph = neighbours.neighbour_graph(x, x, 10, True)
    part = neighbours.balanced_parts(x, graph, 8, 1)
    size = np.bincount(part, minlength=8)
    assert size.max() <= 211 and size.min() >= 189 and (part[graph] == part[:, None]).mean() > 0.9
