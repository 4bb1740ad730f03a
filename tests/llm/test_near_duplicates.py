import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import SCHEMA, no_docs, odd_docs, odd_rows, prose

from tapeline.llm import buckets, simhash
from tapeline.llm import components as C


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def least(ids, fps):
    u = np.array(fps, np.uint64)
    a, b = np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= 3)
    node, root = C.star_forest(a, b)
    group = np.arange(len(u))
    group[node] = root
    frame = pd.DataFrame({"id": ids, "g": group})
    return frame.g.map(frame.groupby("g").id.min()).tolist()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3, unique=True))
def test_near_fingerprints_share_a_key(fp, flips):
    near = fp
    for b in flips:
        near ^= 1 << b
    one, two = (set(simhash.golay_keys(np.array([x], np.uint64).view(np.int64))[0].tolist()) for x in (fp, near))
    assert one & two and len(one) <= 86


def test_codewords_cover():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 500)
    index, count = simhash.codewords(words)
    assert set(count.tolist()) <= {1, 6}
    low, high, _, _ = simhash._golay()
    for w, own, k in zip(words.tolist(), index.tolist(), count.tolist()):
        for m in own[:k]:
            code = m << 11 | int(low[(m << 11) & 0xFFF] ^ high[(m << 11) >> 12])
            assert (code ^ w).bit_count() <= 4


def test_components_against_brute_force(spark):
    rng, rows = random.Random(4), []
    for k in range(60):
        words = prose(k, 40 + k).split()
        for c in range(rng.randint(1, 6)):
            other = list(words)
            for _ in range(rng.randint(0, 2)):
                other[rng.randrange(len(other))] = "edit"
            rows.append((len(rows) * 7 % 1009, " ".join(other), "en", "s", 1))
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).toPandas().set_index("doc_id")
    ids, fps = [r[0] for r in rows], [plain(r[1]) for r in rows]
    assert [int(x) & (2**64 - 1) for x in got.fp.loc[ids]] == fps
    assert got.component_id.loc[ids].tolist() == least(ids, fps)
    kept = simhash.one_of_each(spark.createDataFrame(rows, SCHEMA), ("doc_id", "text", "lang", "source", "n_chars"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least(ids, fps)))


def test_odd_rows(spark):
    got = simhash.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == len(odd_rows())
    blank = [r for r in got if r.fp == 0]
    assert {r.component_id for r in blank} == {3} and sum(r.doc_id is None for r in blank) == 1
    assert {r.component_id for r in got if r.doc_id in (1, 2, 8)} == {1}
    kept = simhash.one_of_each(odd_docs(spark), ("doc_id", "text", "lang", "source", "n_chars")).collect()
    assert sum(r.doc_id in (1, 2, 8) for r in kept) == 1 and sum(r.doc_id is None for r in kept) == 1
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


@pytest.mark.parametrize("cell", [2048, 7])
def test_buckets_give_every_pair_once(spark, cell):
    import pyarrow as pa

    def pairs(rows, i, j):
        x = rows.column("x").to_numpy()
        return pa.table({"a": pa.array(np.minimum(x[i], x[j])), "b": pa.array(np.maximum(x[i], x[j]))})

    size = [1, 2, 3, 7, 8, 30, 50]
    rows = [(k, 100 * k + x) for k, n in enumerate(size) for x in range(n)]
    df = spark.createDataFrame(rows, "key bigint, x bigint").repartition(3)
    got = sorted((r.a, r.b) for r in buckets.in_buckets(df, pairs, "a bigint, b bigint", "test-buckets", cell).collect())
    assert got == sorted((100 * k + x, 100 * k + y) for k, n in enumerate(size) for y in range(n) for x in range(y))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5001), (5001, 5000), (7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in C.components(spark.createDataFrame(edges, "x bigint, y bigint").repartition(8), "test-components").collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}, 5001: 5000}
