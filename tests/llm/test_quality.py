import numpy as np
from pyspark.sql import functions as F
from tests.llm.cases import no_docs, odd_docs, odd_rows, prose

from tapeline.llm import quality as Q


def numbers(texts):
    return [np.array(sorted(Q.slot(w) for w in Q.words(t)), np.int64) for t in texts]


def test_thresholds_rise_and_grades_are_told_apart():
    texts = [prose(i, 20) + (" bad" * (i % 3 == 0)) + (" fine" * (i % 3 == 2)) for i in range(300)]
    grades = np.array([i % 3 for i in range(300)])
    model = Q.fit(numbers(texts), grades, 3)
    assert model.thresholds[0] < model.thresholds[1]
    z = np.array([model.weights[s].sum() for s in numbers(texts)])
    below = model.at_most(z)
    expected = (1 - below).sum(axis=1)
    assert expected[grades == 0].max() < expected[grades == 1].min() and expected[grades == 1].max() < expected[grades == 2].min()
    assert ((0 <= below) & (below <= 1)).all() and (below[:, 0] <= below[:, 1]).all()


def loss(weights, first, gaps, texts, grades, ridge):
    """Mean negative log likelihood of the grades, one text at a time."""
    cuts, total = np.concatenate(([-np.inf], first + np.concatenate(([0.0], np.cumsum(np.exp(gaps)))), [np.inf])), 0.0
    for t, g in zip(texts, grades):
        z = sum(weights[w] for w in t)
        total -= np.log(1 / (1 + np.exp(z - cuts[g + 1])) - 1 / (1 + np.exp(z - cuts[g])))
    return total / len(texts) + ridge / 2 * sum(w * w for w in weights.values())


def test_fit_is_at_the_least_loss():
    """No single weight or threshold can be moved to a lower loss: the slopes that the fit follows are those of the likelihood."""
    rng = np.random.default_rng(4)
    grades = np.array([i % 4 for i in range(160)])
    texts = [np.flatnonzero(rng.random(6) < 0.2 + 0.15 * g * np.arange(6) / 6) + 10 for g in grades]
    model = Q.fit(texts, grades, 4, steps=4000, rate=0.02, ridge=0.01, least=1)
    weights = {w: model.weights[w] for w in range(10, 16)}
    first, gaps = model.thresholds[0], np.log(np.diff(model.thresholds))
    best = loss(weights, first, gaps, texts, grades, 0.01)
    for d in (-0.05, 0.05):
        assert loss(weights, first + d, gaps, texts, grades, 0.01) > best
        for k in range(2):
            assert loss(weights, first, gaps + d * (np.arange(2) == k), texts, grades, 0.01) > best
        for w in weights:
            assert loss(weights | {w: weights[w] + d}, first, gaps, texts, grades, 0.01) > best


def test_grades_against_sums_written_out(spark):
    rng = np.random.default_rng(5)
    model = Q.Model(rng.normal(size=1 << Q.BITS), np.array([-0.5, 0.7]))
    got = {r.doc_id: (r.expected_grade, r.tail_probability) for r in Q.grade(odd_docs(spark), model, 2).collect()}
    for doc, text, *_ in odd_rows():
        if doc is not None:
            z = sum(model.weights[Q.slot(w)] for w in Q.words(text or ""))
            above = [1 - 1 / (1 + np.exp(np.clip(z - t, -40, 40))) for t in model.thresholds]
            assert np.allclose(got[doc], (sum(above), above[1]), atol=1e-9)


def test_held_out_selection(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", Q.graded(F.col("quality"), F.col("toxic")).alias("grade"))
    model = Q.train(docs, labels.where("doc_id % 4 <> 0"), 3)
    held = docs.join(labels.where("doc_id % 4 = 0"), "doc_id")
    got = Q.grade(held, model, 2, ("doc_id", "grade")).toPandas()
    kept = got.tail_probability >= 0.5
    assert kept[got.grade == 2].mean() > 0.98 and kept[got.grade == 1].mean() < 0.2
    # about four in ten toxic labels are on texts without a toxic word
    assert kept[got.grade == 0].mean() < 0.45


def test_odd_rows(spark):
    docs = odd_docs(spark)
    ratings = spark.createDataFrame([(1, 2), (1, 0), (None, 1), (3, 1), (4, 9), (10, None), (12, 1), (13, 2)], "doc_id bigint, grade int")
    got = Q.grade(docs, Q.train(docs, ratings, 3), 2).toPandas()
    assert len(got) == len(odd_rows()) and got.expected_grade.between(0, 2).all() and got.tail_probability.between(0, 1).all()
    same = got[got.doc_id == 2]
    assert len(same) == 2 and same.expected_grade.nunique() == 1


def test_no_ratings_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, grade int")
    model = Q.train(odd_docs(spark), none, 3)
    assert np.allclose(Q.grade(odd_docs(spark), model, 2).toPandas().expected_grade, 1)
    assert Q.grade(no_docs(spark), model, 2).count() == 0


def test_words_of_blocks(monkeypatch):
    text = prose(5, 500)
    whole = Q.words(text)
    monkeypatch.setattr(Q, "_BLOCK", 50)
    assert Q.words(text) == whole
