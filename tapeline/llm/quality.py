"""Quality classifier: ordinal regression with cumulative links on hashed words.

Ratings are grades 0 to K-1. One weight vector over hashed words is shared by all grades: P(grade <= k) is the logistic
of (threshold k - weight sum), with thresholds that rise by construction. Scoring gives the expected grade and the
probability of a grade of at least ``select``, by which documents are chosen.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import bound_batches, pick

BITS = 18
#: Rated documents that the model is fitted on, in expectation: the bound of the sample.
FITTED_TEXTS = 8000
TOKEN = re.compile(r"\w+|[^\w\s]+")
_BLOCK = 1 << 20


def words(text: str) -> set[str]:
    """Features of the whole text: distinct lower-case words and runs of other signs, and how repetitive it is.

    The latter are names of buckets, which no word can equal: the share of distinct among all words together with the
    power of two of their number, and the share of words that follow an equal one.
    """
    out: set[str] = set()
    low, at, total, again, last = text.lower(), 0, 0, 0, ""
    while at < len(low):
        end = low.find(" ", at + _BLOCK)
        end = len(low) if end < 0 else end
        got = TOKEN.findall(low, at, end)
        if got:
            again += sum(map(str.__eq__, got, [last, *got[:-1]]))
            total, last = total + len(got), got[-1]
            out.update(got)
        at = end
    if total:
        out |= {f" distinct {10 * len(out) // total} of {total.bit_length() // 2}", f" again {min(9, 20 * again // total)}", f" words {total.bit_length() // 2}"}
    return out


def slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


class Model:
    """Weights by slot, and thresholds in rising order (one fewer than grades)."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def at_most(self, z: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each z and each k but the last."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - z[:, None], -40, 40)))


def fit(texts: list[np.ndarray], grades: np.ndarray, n_grades: int, steps: int = 300, rate: float = 0.05, ridge: float = 2e-4, least: int = 5) -> Model:
    """Full-batch Adam on the mean negative log likelihood, words in fewer than ``least`` texts get no weight."""
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    columns = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    seen = np.bincount(columns, minlength=1 << BITS)
    use = seen[columns] >= least
    rows, columns = rows[use], columns[use]
    live, columns = np.unique(columns, return_inverse=True)
    heavy = np.full(len(grades), 1 / max(len(grades), 1))
    # parameters: weights, the first threshold, logs of the gaps between thresholds
    theta = np.concatenate((np.zeros(len(live)), [-1.0], np.zeros(n_grades - 2)))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n = len(live)
    each = np.arange(len(grades))
    for step in range(1, steps + 1):
        z = np.bincount(rows, theta[columns], minlength=len(texts))
        gaps = np.exp(theta[n + 1 :])
        cuts = theta[n] + np.concatenate(([0.0], np.cumsum(gaps)))
        below = np.concatenate((np.zeros((len(z), 1)), 1 / (1 + np.exp(-np.clip(cuts[None] - z[:, None], -40, 40))), np.ones((len(z), 1))), axis=1)
        slope = below * (1 - below)
        p = np.maximum(below[each, grades + 1] - below[each, grades], 1e-12)
        d_hi, d_lo = heavy * slope[each, grades + 1] / p, heavy * slope[each, grades] / p
        dz = d_hi - d_lo
        d_cut = np.array([-d_hi[grades == k].sum() + d_lo[grades == k + 1].sum() for k in range(n_grades - 1)])
        d_gap = np.array([d_cut[k + 1 :].sum() for k in range(n_grades - 2)]) * gaps
        g = np.concatenate((np.bincount(columns, dz[rows], minlength=n) + ridge * theta[:n], [d_cut.sum()], d_gap))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    weights = np.zeros(1 << BITS)
    weights[live] = theta[:n]
    return Model(weights, theta[n] + np.concatenate(([0.0], np.cumsum(np.exp(theta[n + 1 :])))))


def train(docs: DataFrame, ratings: DataFrame, n_grades: int, texts: int = FITTED_TEXTS, seed: int = 3) -> Model:
    """A model from ``docs`` (doc_id, text) and ``ratings`` (doc_id, grade).

    A hash of the id draws about ``texts`` of the rated documents; their hashed words, no other rows, go to the
    driver. Null ids, texts and grades, and grades out of range, are not learned from; an id that is rated twice counts
    with its lowest grade. Without any ratings all documents get the middle of the scale.
    """
    rated = pick(ratings, "doc_id", "grade").where(F.col("doc_id").isNotNull() & F.col("grade").between(0, n_grades - 1))
    rated = rated.groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    rate = min(1.0, texts / max(1, rated.count()))
    drawn = rated.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < int(rate * (1 << 30)))
    rows = pick(docs, "doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(drawn), "doc_id").select("grade", "text")  # the bounded sample

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [[slot(w) for w in words(t)] for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(slots, pa.list_(pa.int32()))], ["grade", "slots"])

    got = rows.mapInArrow(hashed, "grade int, slots array<int>").toArrow()
    order = sorted(zip(got.column("grade").to_pylist(), got.column("slots").to_pylist()), key=lambda r: (r[0], sorted(r[1])))
    if not order:
        return Model(np.zeros(1 << BITS), np.arange(n_grades - 1) - (n_grades - 2) / 2)
    return fit([np.sort(np.array(s, np.int64)) for _, s in order], np.array([g for g, _ in order]), n_grades)


class _Weights(dict):
    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        w = float(self.weights[slot(word)])
        if len(self) < 500_000:
            self[word] = w
        return w


def grade(docs: DataFrame, model: Model, select: int, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep``, ``expected_grade`` and ``tail_probability``, that of a grade of ``select`` or more.

    Null and empty texts have no words and get what the thresholds alone say. Repeated rows and null ids come out as they
    came in; whole texts count, of any length; an empty table gives an empty one; other columns are ignored.
    """
    rows = bound_batches(pick(docs, *keep, "text")).withColumn("text", F.col("text").cast("string"))
    kinds, at = dict(rows.dtypes), len(keep)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))  # fixed size: 2^BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, thresholds = shared.value
        known, scale = _Weights(weights), Model(weights, thresholds)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                z = np.array([sum(map(known.__getitem__, sorted(words(t or "")))) for t in part.column(at).to_pylist()], np.float64)
                above = 1 - scale.at_most(z)
                yield pa.record_batch([*part.columns[:at], pa.array(above.sum(axis=1)), pa.array(above[:, select - 1])], [*part.schema.names[:at], "expected_grade", "tail_probability"])

    return rows.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "expected_grade double, tail_probability double"]))


def graded(quality: Column, toxic: Column) -> Column:
    """Grade from the labels: 0 toxic, 1 poor, 2 good; null where the labels are."""
    return F.when(toxic == 1, 0).when(toxic.isNull() | quality.isNull(), None).otherwise(quality.cast("int") + 1)
