from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import no_docs, odd_docs, odd_rows

from tapeline.llm import filter_audit as A

LABELS = "doc_id bigint, quality int, toxic int"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failing(rows):
    """The set of filters each row fails, one by one."""
    first = {}
    for doc, text, *_ in rows:
        key = (doc is None, doc or 0)
        first[text or ""] = min(first.get(text or "", key), key)
    out = []
    for doc, text, *_ in rows:
        t = text or ""
        w = t.encode().split()
        fails = {"A"} if len(w) < 100 else set()
        fails |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t) else set()
        fails |= {"D"} if any(c in t for c in "#$%&*|") else set()
        fails |= {"E"} if (doc is None, doc or 0) > first[t] else set()
        out.append(fails)
    return out


def plain(rows, labels):
    """Each order applied to every row in turn."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out, shapley = {}, Counter()
    for (doc, _, lang, *_), fails in zip(rows, failing(rows)):
        part = lang or ""
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                c = out.setdefault((part, order, step), Counter())
                c["redundant"] += f in fails and gone
                c["unique_fails"] += fails == {f}
                if f in fails and not gone:
                    gone = True
                    c["removed"] += 1
                    c["good_lost"] += doc in good
                    c["toxic_lost"] += doc in toxic
                    shapley[part, f] += 1
                c["kept"] += not gone
    return {k: tuple(shapley[k[0], k[1][k[2] - 1]] if m == "shapley" else c[m] for m in COUNTS) for k, c in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r[m] for m in COUNTS) for r in df.collect()}


def test_odd_rows_against_every_order_applied(spark):
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (7, 1, 1), (None, 1, 1), (99, 1, 1), (12, None, 1)]
    frame = spark.createDataFrame([(*r, 5) for r in labels], LABELS + ", x int").toDF("doc_id", "quality", "toxic", "Quality")
    got = found(A.audit(odd_docs(spark), frame))
    assert got == plain(odd_rows(), labels) and len(got) == 600 * len({r[2] or "" for r in odd_rows()})


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert A.audit(no_docs(spark), none).count() == 0
    assert found(A.audit(odd_docs(spark), none)) == plain(odd_rows(), [])


def test_a_text_with_many_copies(spark):
    rows = [(i, "same text $", "en" if i % 3 else None, "s", 1) for i in range(5000)] + [(5000 + i, f"word{i} " * 120, "en", "s", 1) for i in range(50)]
    got = found(A.audit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(7), spark.createDataFrame([], LABELS)))
    assert got == plain(rows, [])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 31), st.integers(0, 2**62 // 32)), max_size=32))
def test_fields_do_not_run_into_each_other(counts):
    fields, table = A.outcomes()
    for m in A.MEASURES:
        want = sum((n * A.unpack(table[m][mask], len(fields)).astype(object) for mask, n in counts), np.zeros(len(fields), object))
        assert A.unpack(sum(n * table[m][mask] for mask, n in counts), len(fields)).tolist() == want.tolist()


def test_whole_table_against_sql(spark, sf_dir):
    from tapeline.llm.queries import OP12_SQL, op12_filter_audit

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    rel = con.execute(OP12_SQL)
    at = [d[0] for d in rel.description]
    want = {(r[at.index("part")], r[at.index("filter_order")], r[at.index("step")]): tuple(r[at.index(m)] for m in COUNTS) for r in rel.fetchall()}
    assert found(op12_filter_audit(spark, sf_dir)) == want
