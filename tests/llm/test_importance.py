import hashlib
import math
import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import SCHEMA, no_docs, odd_docs, odd_rows, prose

from tapeline.llm import importance as I

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(low)
    return w, [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain(rows, target, percent=5, least=20, buckets=10_000, seed=42):
    hashed = lambda text: [zlib.crc32(g.encode()) % buckets for g in grams(text)[1]]
    s, t = Counter(b for _, x in rows for b in hashed(x)), Counter(b for x in target for b in hashed(x))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    out = []
    for doc, x in rows:
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in hashed(x))
        out.append((doc, len(grams(x)[0]), len(hashed(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = [(*r, k + 1) for k, r in enumerate(able[: percent * len(able) // 100])]
    rest = able[len(drawn) :] + [r for r in out if r[1] < least]
    return sorted(drawn + [(*r, None) for r in rest], key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZ9é日 .\x00\x7f_'\n", max_size=60), st.integers(1, 12))
def test_pieces_have_the_features_of_the_whole_text(text, size):
    got = Counter(x for lists in I.features(text.encode(), size) for part in lists for x in part)
    assert got == Counter(zlib.crc32(g.encode()) for g in grams(text)[1])


def test_odd_rows_against_a_plain_version(spark):
    target = ["the river and the stone", None, "", "Winter COPPER signal"]
    frame = spark.createDataFrame([(k, x, "z") for k, x in enumerate(target)], "item_id bigint, text string, y string").toDF("item_id", "text", "Text")
    rows = [(r[0], r[1]) for r in odd_rows()]
    for percent in (5, 40, 100):
        assert found(I.resample(odd_docs(spark), frame, percent)) == plain(rows, target, percent)


def test_draw_leans_to_the_target_and_ties_go_to_smaller_ids(spark):
    rng = random.Random(3)
    near = [(k, " ".join(rng.choice(["ocean", "tide", "reef", "the", "of"]) for _ in range(30)), "en", "s", 1) for k in range(200)]
    far = [(1000 + k, prose(k, 30), "en", "s", 1) for k in range(1800)]
    docs = spark.createDataFrame(near + far, SCHEMA).repartition(5)
    sea = lambda: " ".join(rng.choice(["ocean", "tide", "reef", "the", "of"]) for _ in range(30))
    target = spark.createDataFrame([(sea(),) for _ in range(2000)], "text string")
    got = [r for r in I.resample(docs, target, keep=("text",)).collect() if r["rank"]]
    assert sorted(r["rank"] for r in got) == list(range(1, 101))
    assert sum(r.doc_id < 1000 for r in got) > 90, [(r.doc_id, r.weight, r.score) for r in got][:20]
    assert all("ocean" in r.text or "tide" in r.text for r in got if r.doc_id < 1000)
    twins = spark.createDataFrame([(7, prose(1, 30))] * 50 + [(8, prose(2, 30))] * 50, "doc_id bigint, text string")
    assert found(I.resample(twins, target.limit(0), 50)) == plain([(7, prose(1, 30))] * 50 + [(8, prose(2, 30))] * 50, [], 50)


def test_empty_tables(spark):
    target = spark.createDataFrame([("the river",)], "text string")
    assert I.resample(no_docs(spark), target).count() == 0
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert found(I.resample(odd_docs(spark), target.limit(0), 50)) == plain(rows, [], 50)
