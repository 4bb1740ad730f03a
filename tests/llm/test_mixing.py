import re

import pytest
from pyspark.sql import functions as F
from tests.llm.cases import SCHEMA, no_docs, odd_docs, odd_rows, prose

from tapeline.llm import mixing


def targets(sizes, weights=(1, 2, 3), epochs=3):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, free = {}, float(sum(sizes.values())), set(order)
    while free:
        share = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / share > epochs * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / share for s in free}
        for s in over:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
            free.discard(s)
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_sizes(spark):
    got = mixing.mix(odd_docs(spark), keep=("source",)).toPandas()
    sizes = {}
    for _, text, _, source, _ in odd_rows():
        sizes[source] = sizes.get(source, 0) + words(text)
    want = targets(sizes)
    assert len(got) == len(odd_rows())
    for r in got.itertuples():
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)


def test_taken_is_near_target_and_agrees(spark):
    rows = [(i, prose(i, 20 + i % 30), "en", f"s{i % 7}" if i % 3 else "hot", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, SCHEMA)
    one, two = (mixing.mix(d, keep=("source",)).toPandas().sort_values("doc_id") for d in (docs, docs.repartition(7)))
    assert one.reset_index(drop=True).equals(two.reset_index(drop=True))
    by = one.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by.taken - by.target).abs() <= 2 * 50).all() and one.taken.sum() <= one["size"].sum()


def test_small_source_is_capped(spark):
    rows = [(i, prose(i, 50), "en", "big", 1) for i in range(40)] + [(100, prose(1, 10), "en", "zsmall", 1)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).toPandas().set_index("doc_id")
    assert got.target[100] == 30.0 and got.taken[100] == 30


def test_taken_rows_are_documents(spark):
    docs = odd_docs(spark)
    taken = mixing.mix(docs).toPandas()
    rows = mixing.take_mix(docs, ("doc_id", "text", "lang", "source", "n_chars"))
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert rows.count() == (taken.taken[taken["size"] > 0] // taken["size"][taken["size"] > 0]).sum()


def queues(rows, weights=(1, 2, 3), epochs=3):
    """Words taken of each row, by serving the queues one entry after another. Rows: (shuffle hash, doc_id, text, source)."""
    sizes, queue = {}, {}
    for h, doc, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
        queue.setdefault(source, []).append((h, doc is None, doc or 0, words(text)))
    target, order = targets(sizes, weights, epochs), sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    served, entries, row = dict.fromkeys(sizes, 0), [], 0
    for rank, source in enumerate(order):
        queue[source].sort()
        for epoch in range(epochs):
            for k, (_, none, doc, size) in enumerate(queue[source]):
                if size:
                    served[source] += size
                    entries.append((served[source] / target[source], rank, epoch, k, none, doc, size))
    budget, total, taken = sum(sizes.values()), 0, {}
    for *_, none, doc, size in sorted(entries):
        if total + size <= budget:
            taken[None if none else doc] = taken.get(None if none else doc, 0) + size
        total += size
    return taken


def test_taken_words_are_those_of_queues_served_in_turn(spark):
    rows = [(i, prose(i, 5 + i * 7 % 40), "en", [None, "a", "b", "c", "tiny"][min(i % 4, 3) if i % 50 else 4], 1) for i in range(400)] + [(1000, None, "en", "a", 1), (1001, "", "en", "none", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    hashed = [tuple(r) for r in docs.select(F.xxhash64(F.lit(7), "doc_id"), "doc_id", "text", "source").collect()]
    got = {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    assert got == queues(hashed)


def test_empty_table(spark):
    assert mixing.take_mix(no_docs(spark), ("doc_id", "text", "lang", "source", "n_chars")).count() == 0
    assert mixing.mix(no_docs(spark)).count() == 0
