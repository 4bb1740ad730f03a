import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import SCHEMA, no_docs, odd_docs, odd_rows, prose

from tapeline.llm import substring_dedup as D
from tapeline.llm.suffixes import suffix_order


@settings(max_examples=400, deadline=None)
@given(st.text("ab", max_size=60) | st.text("abcz", max_size=40) | st.text(max_size=30))
def test_suffix_order(text):
    assert suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


def reference(rows, length):
    """kept bytes and number of spans by (doc_id, text)."""
    seen, out = set(), {}
    docs = {(r[0], r[1] or "") for r in rows}
    import xxhash

    rid = lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)
    for doc, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, rid(d[1]))):
        b = text.encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if (w := b[i : i + length]) in seen:
                gone[i : i + length] = True
            seen.add(w)
        out[doc, len(b), bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])] = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
    return out


def check(spark, docs, rows, length=100, cell=D.CELL):
    got = D.remove_repeats(docs, length, cell=cell).collect()
    assert len(got) == len(rows)
    have = {(r.doc_id, r.n_bytes, bytes(r.kept)): r.n_spans for r in got}
    assert have == reference(rows, length) and all(r.n_removed == r.n_bytes - len(r.kept) for r in got)


@pytest.mark.parametrize("cell", [D.CELL, 3, 1])
def test_shared_passages(spark, cell):
    rng, rows = random.Random(6), []
    passages = [prose(1000 + k, 12 + 4 * k) for k in range(8)]
    for k in range(120):
        parts = [prose(k, rng.randint(0, 30))] + [rng.choice(passages)[: rng.randint(60, 400)] for _ in range(rng.randint(0, 3))] + [prose(5000 + k, rng.randint(0, 20))]
        rng.shuffle(parts)
        rows.append((k, " ".join(parts), "en", "s", 1))
    rows += [(200, "the " * 400, "en", "s", 1), (201, "the " * 390 + "end", "en", "s", 1), (202, "ß" * 300, "en", "s", 1), (203, rows[4][1], "en", "s", 1)]
    check(spark, spark.createDataFrame(rows, SCHEMA).repartition(5), rows, cell=cell)


def test_odd_rows(spark):
    check(spark, odd_docs(spark), odd_rows())
    assert D.remove_repeats(no_docs(spark)).count() == 0


def test_texts_longer_than_a_block(spark, monkeypatch):
    text = bytes(random.Random(3).choices(b"abcdefgh", k=5000))
    whole = D.runs(text)
    monkeypatch.setattr(D, "BLOCK", 1000)
    parts = D.runs(text)
    windows = lambda r: {(int(lo) + k, int(a)) for a, _, lo, n, _ in zip(*r) for k in range(int(n))}
    assert {w for w, _ in windows(parts)} == set(range(len(text) - 99)) and windows(parts) == windows(whole)


def test_large_groups_meet_by_hash(spark):
    passage = prose(77, 22)[:110]
    rows = [(k, f"{prose(k, 15)} {passage} {prose(900 + k, 15)}", "en", "s", 1) for k in range(60)]
    check(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), rows, cell=5)
