import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.cases import SCHEMA, no_docs, odd_docs, odd_rows

from tapeline.llm import language as L


def test_profile_is_the_sum_of_bound_letters():
    v = L.GramVectors(64)
    got, n = v.profiles(["Ab a1"])
    want = np.zeros(64)
    for gram in ("\0ab", "ab\0", "b\0a", "\0a\0"):
        bound = np.ones(64)
        for i, c in enumerate(reversed(gram)):
            bound = bound * np.roll(v.of_letter(ord(c)), i)
        want += bound
    assert n[0] == 4 and np.allclose(got[0] * 4, want)


def test_texts_do_not_mix_and_long_ones_count_whole():
    v = L.GramVectors(64)
    one = [v.profiles([t])[0][0] for t in ("hello world", "", "wörld " * 5)]
    assert np.allclose(v.profiles(["hello world", "", "wörld " * 5])[0], one)
    half = "abcdefg " * 40_000
    assert v.profiles([half])[1][0] == pytest.approx(len(half), rel=0.001)


def test_memory_of_grams_is_bounded(monkeypatch):
    monkeypatch.setattr(L.GramVectors, "KEPT", 50)
    v = L.GramVectors(64)
    texts = ["".join(chr(97 + (i * j) % 26) for j in range(40)) for i in range(1, 30)]
    got = [v.profiles([t])[0][0] for t in texts]
    monkeypatch.setattr(L.GramVectors, "KEPT", 20_000)
    assert np.allclose(got, L.GramVectors(64).profiles(texts)[0], atol=1e-5)


@pytest.mark.parametrize("size", [1, 3, 7, 64])
def test_blocks_have_the_grams_of_the_whole_text(size, monkeypatch):
    texts = ["ab  12 3cd, Éf" * 3, "....", "a", " x ", "", "ΑΣ ΑΣΑ. " * 4, "123 " * 30 + "z"]
    whole = [sorted(L.grams([L.ended(t)])[0].tolist()) for t in texts]
    want, n = L.GramVectors(64).profiles(texts)
    monkeypatch.setattr(L, "_BLOCK", size)
    assert [sorted(g for b in L.blocks_of(t) for g in L.grams([b])[0].tolist()) for t in texts] == whole
    got, m = L.GramVectors(64).profiles(texts)
    assert np.allclose(got, want, atol=1e-6) and (m == n).all()


def test_choice_is_the_nearest_centred_prototype(spark, sf_dir):
    """Profiles, centring, cosine and choice written out one text at a time."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, matrix = L.prototypes(docs.where(~L.held_out(F.col("doc_id"))))
    v, centre = L.GramVectors(matrix.shape[1]), matrix.mean(axis=0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(docs, names, matrix).collect()}
    for r in docs.select("doc_id", "text").collect()[::5]:
        low = "\0" + "".join(c if c.isalpha() else "\0" for c in (r.text or "").lower()) + "\0"
        while "\0\0" in low:
            low = low.replace("\0\0", "\0")
        if low == "\0":
            assert got[r.doc_id] == ("und", 0.0)
            continue
        profile = np.zeros(matrix.shape[1])
        for i in range(len(low) - 2):
            profile += v.of_gram(sum(ord(c) << 21 * (2 - k) for k, c in enumerate(low[i : i + 3])))
        profile = profile / np.linalg.norm(profile) - centre
        cosine = [profile @ (p - centre) / np.linalg.norm(profile) / np.linalg.norm(p - centre) for p in matrix]
        best = int(np.argmax(cosine))
        assert got[r.doc_id][0] == names[best] and got[r.doc_id][1] == pytest.approx(max(0, cosine[best]), abs=1e-4)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, matrix = L.prototypes(docs.where(~L.held_out(F.col("doc_id"))))
    got = L.identify(docs, names, matrix, ("doc_id", "lang")).toPandas()
    held = got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)
    assert held.sum() > 50 and (got.lang_pred == got.lang)[held].mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_odd_rows(spark):
    docs = odd_docs(spark)
    names, matrix = L.prototypes(spark.createDataFrame(odd_rows(), SCHEMA))
    got = L.identify(docs, names, matrix).toPandas()
    assert len(got) == len(odd_rows()) and sorted(names) == ["en", "xx"]
    blank = [i for i, r in enumerate(odd_rows()) if not any(c.isalpha() for c in r[1] or "")]
    assert (got.iloc[blank].lang_pred == "und").all() and (got.iloc[blank].score == 0).all()
    assert set(got.lang_pred) <= {"en", "xx", "und"}
    assert L.speaks(docs, ("doc_id", "text", "lang", "source", "n_chars")).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_nothing_learned(spark):
    names, matrix = L.prototypes(no_docs(spark))
    assert names == [] and set(L.identify(odd_docs(spark), names, matrix).toPandas().lang_pred) == {"und"}
    assert L.identify(no_docs(spark), names, matrix).count() == 0


def test_one_language(spark):
    names, matrix = L.prototypes(spark.createDataFrame([(1, "hello there", "en", "s", 1)], SCHEMA))
    row = L.identify(spark.createDataFrame([(2, "hello there", None, "s", 1)], SCHEMA), names, matrix).first()
    assert row.lang_pred == "en" and row.score == pytest.approx(1, abs=1e-6)


FOREIGN = {
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
}


def test_stage_keeps_learned_languages_and_no_others(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(3)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), n)) for n in (300, 600, 1500, 4000) for _ in range(10)]
    texts = [*[a + b for a in FOREIGN.values() for b in FOREIGN.values() if a < b], *noise]
    kind = dict(docs.dtypes)["doc_id"]
    planted = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    rows = docs.unionByName(planted.withColumn("doc_id", F.col("doc_id").cast(kind)))
    ids = {r.doc_id for r in L.speaks(rows, ("doc_id", "text", "lang")).select("doc_id").collect()}
    learned = {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
    assert ids == learned


def test_limits_need_enough_texts_and_rise_with_variety(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    names, matrix = L.prototypes(docs)
    got = L.limits(L.drawn(docs), names, matrix)
    assert set(got) == set(names) and all(0.1 < v < 0.5 for by in got.values() for k, v in by.items() if k >= 6)
    assert L.limits(L.drawn(docs), names, matrix, 10_000) == {}


def test_copies_are_drawn_once(spark):
    kinds = [("copied text", "aa", 5000), ("other text", "bb", 3000), ("third one", "bb", 3000)]
    rows = [(t, lang) for t, lang, n in kinds for _ in range(n)] + [(f"text {chr(97 + i % 26)}{chr(97 + i // 26)}", "aa") for i in range(600)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for seed in range(4):
        got = L.drawn(docs, 300, seed).toPandas()
        assert not got.duplicated().any() and 200 < (got.lang == "aa").sum() < 400
        assert set(got[got.lang == "bb"].text) == {"other text", "third one"}


def test_stage_learns_from_all_texts(spark, monkeypatch):
    """No draw: with one text a language to be drawn, languages and limits are still those of the whole table."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    seen = []
    monkeypatch.setattr(L, "drawn", lambda *_: pytest.fail("a sample was drawn"))
    monkeypatch.setattr(L, "limits_of", lambda fits, *_: seen.append(fits.count()) or {})
    L.speaks(docs, ("doc_id", "text", "lang"))
    kept = docs.where(~L.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    assert seen == [kept.select("lang", "text").distinct().count()]
