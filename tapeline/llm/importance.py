"""Importance resampling towards a target distribution, over hashed n-grams.

A table of 256 bytes lower-cases Latin letters and blanks what separates words, ``bytes.split`` yields the words, and the
CRC of a shorter n-gram is the seed of the longer one's, so no n-gram is ever put together. Pass one counts the buckets
of all documents and of the target texts; pass two weighs each document by its features' log ratios. Adding Gumbel noise
from a hash of the document's id and taking the highest scores draws without replacement in proportion to the weights.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat
from operator import mod
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import bound_batches, pick, prefix_sums
from tapeline.session import staged

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of a text that are split at once; its features are those of the whole text, as cuts are made between words.
PIECE = 1 << 20
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text with separators blanked, cut at blanks so that a piece holds ``size`` bytes or one longer word."""
    text, at = text.translate(_TABLE), 0
    while len(text) - at > size:
        cut = text.rfind(b" ", at, at + size)
        cut = cut if cut > at else text.find(b" ", at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def features(text: bytes, size: int = PIECE) -> Iterator[tuple[list[int], ...]]:
    """Hashes of runs of one, two and three words, a piece of the text at a time."""
    one: list[int] = []  # hashes of the last word and of the last two words so far
    two: list[int] = []
    for piece in pieces(text, size):
        words = piece.split()
        spaced = [b" " + w for w in words]
        ones = list(map(crc32, words))
        twos = list(map(crc32, spaced[1 - len(one) :], one + ones))
        threes = list(map(crc32, spaced[2 - len(one) - len(two) :], two + twos))
        yield ones, twos, threes
        one, two = (one + ones)[-1:], (two + twos)[-1:]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = batch.slice(lo, 256)
            yield rows, rows.column(rows.schema.get_field_index("text")).cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts (column text) fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for _, rows in _texts(batches):
            for text in rows:
                for lists in features(text or b""):
                    found.update(map(mod, chain(*lists), repeat(buckets)))
        yield pa.record_batch([pa.array(found.keys(), pa.int32()), pa.array(found.values(), pa.int64())], ["bucket", "n"])

    text = bound_batches(pick(texts, "text")).select(F.col("text").cast("string").alias("text"))
    found = text.mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # a row for each bucket at most
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the log ratio of each bucket's share of the target to its share of the source, one added to each count."""
    s_all, t_all = float(source.sum() + len(source)), float(target.sum() + len(target))
    return [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist())]


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel variable, from a hash of the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: list[int], keep: tuple[str, ...] = (), seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each row, and the columns of ``keep``."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = gain.__getitem__
        for rows, texts in _texts(batches):
            out = []
            for doc_id, text in zip(rows.column(0).to_pylist(), texts):
                words = n = weight = 0
                for lists in features(text or b""):
                    words += len(lists[0])
                    n += sum(map(len, lists))
                    weight += sum(map(of, map(mod, chain(*lists), repeat(len(gain)))))
                out.append((words, n, weight, weight + noise(doc_id, seed)))
            kept = [rows.column(rows.schema.get_field_index(c)) for c in ("doc_id", *keep)]
            yield pa.record_batch([*kept, *(pa.array(c, pa.int64()) for c in zip(*out))], ["doc_id", *keep, "n_words", "n_features", "weight", "score"])

    rows = bound_batches(pick(docs, *dict.fromkeys(("doc_id", "text", *keep))))
    rows = rows.withColumns({"doc_id": F.col("doc_id").cast("bigint"), "text": F.col("text").cast("string")})
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(weigh, ", ".join([f"`{c}` {kinds[c]}" for c in ("doc_id", *keep)] + [f"{c} bigint" for c in ("n_words", "n_features", "weight", "score")]))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_words, n_features, weight, score and rank; ``target`` needs text.

    Of the rows with ``least_words`` words, ``percent`` in a hundred (rounded down) of the highest scores are drawn and
    ranked from 1; ties go to the smaller doc_id, a null one last, and then to the smaller n_features. Other rows have no rank.

    Null and empty texts have no features and weight 0. Repeated rows count, and are drawn, each for itself. The noise of a
    null doc_id is that of an empty one. Texts of any length are weighed whole, a piece at a time. Empty ``docs`` give an
    empty table; an empty ``target`` leaves one added to each bucket. Other columns are ignored but for ``keep``, which are passed on.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = staged(weighed(docs, gain, keep, seed), "importance-rows")
    able = F.col("n_words") >= least_words
    draw = rows.where(able).count() * percent // 100
    order = [-F.col("score"), F.col("doc_id"), F.col("n_features")]
    ranked = prefix_sums(rows.where(able), order, {"rank": F.lit(1)}, "importance-ranks")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < draw, F.col("rank") + 1))
    return ranked.unionByName(rows.where(~able).withColumn("rank", F.lit(None).cast("bigint")))
