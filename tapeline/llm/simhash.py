"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into halves of 23 + 9 bits. A 23-bit segment decodes to the codewords of the binary Golay code
within distance 4: one, or six if the nearest is 3 away. The code is perfect, so two segments that differ in up to two bits
share a codeword: the nearest one of a word between them is at most 3 + 1 away from either. Fingerprints that differ in up
to 3 bits have, by pigeonhole,

* an equal half (keys 1 and 2), or
* one error in one half and at most two in the other. If the one error is in the half's segment, its 9 bits are equal and
  both segments share a codeword (keys 3 and 5); else its segment is equal and the other one shares a codeword (4 and 6).

So fingerprints within 3 bits meet at a key of at least 32 bits, and every meeting pair is verified. Equal fingerprints are
one node of the graph, so groups of copies meet nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.buckets import in_buckets
from tapeline.llm.common import bound_batches, pick
from tapeline.llm.components import components, star_forest
from tapeline.session import staged

SEED = 42
SHINGLE = 3
BITS = 3
#: Fixed value: generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b101011100011
_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles of a UTF-8 text, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - k] + 1))
    ends = ends[k - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, len(starts), _BLOCK):
        h = [digest(joined[s:e], SEED) for s, e in zip(starts[lo : lo + _BLOCK].tolist(), ends[lo : lo + _BLOCK].tolist())]
        ones += np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``fp``, the fingerprint as a signed number, of each row of ``docs`` (text)."""
    rows = bound_batches(pick(docs, *keep, "text")).withColumn("text", F.col("text").cast("string"))
    kinds, at = dict(rows.dtypes), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                fp = np.array([fingerprint(t or b"") for t in part.column(at).cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)
                yield pa.record_batch([*part.columns[:at], pa.array(fp)], [*part.schema.names[:at], "fp"])

    return rows.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "fp bigint"]))


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits; for each remainder the patterns that lead to codewords, and how many."""

    def remainder(v: int) -> int:
        for i in range(22, 10, -1):
            if v >> i & 1:
                v ^= GENERATOR << (i - 11)
        return v

    low = np.array([remainder(v) for v in range(1 << 12)], np.int64)
    high = np.array([remainder(v << 12) for v in range(1 << 11)], np.int64)
    of: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for places in combinations(range(23), weight):
            e = sum(1 << p for p in places)
            of[low[e & 0xFFF] ^ high[e >> 12]].append(e)
    patterns = np.array([(es + es[:1] * 6)[:6] for es in of], np.int64)
    return low, high, patterns, np.array([len(es) for es in of], np.int64)


def codewords(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords within distance 4 of 23-bit segments: (n, 6), and how many of the six are meant."""
    low, high, patterns, count = _golay()
    s = low[segment & 0xFFF] ^ high[segment >> 12]
    return (segment[:, None] ^ patterns[s]) >> 11, count[s]


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) rows at which all fingerprints within 3 bits meet."""
    u = fp.view(np.uint64)
    half = [(u & np.uint64(0xFFFFFFFF)).astype(np.int64), (u >> np.uint64(32)).astype(np.int64)]
    seg, rest = [h & 0x7FFFFF for h in half], [h >> 23 for h in half]
    (ka, na), (kb, nb) = codewords(seg[0]), codewords(seg[1])
    six = np.arange(6)
    use_a, use_b = six < na[:, None], six < nb[:, None]
    use = use_a[:, :, None] & use_b[:, None, :]
    code = (ka[:, :, None] << 12 | kb[:, None, :])[use]
    row = np.broadcast_to(np.arange(len(fp))[:, None, None], use.shape)[use]
    row_a, row_b = np.nonzero(use_a)[0], np.nonzero(use_b)[0]
    kinds = [
        (1, half[0], slice(None)), (2, half[1], slice(None)),
        (3, code << 9 | rest[0][row], row), (5, code << 9 | rest[1][row], row),
        (4, seg[0][row_b] << 12 | kb[use_b], row_b), (6, seg[1][row_a] << 12 | ka[use_a], row_a),
    ]
    return np.concatenate([k | n << 48 for n, k, _ in kinds]), np.concatenate([fp[r] for _, _, r in kinds])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy()
        for lo in range(0, len(fp), 1000):
            key, of = golay_keys(fp[lo : lo + 1000])
            for at in range(0, len(key), 20_000):
                yield pa.record_batch([pa.array(key[at : at + 20_000]), pa.array(of[at : at + 20_000])], ["key", "fp"])


def _near(rows: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.Table:
    fp = rows.column("fp").to_numpy()
    near = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= BITS
    a, b = star_forest(fp[i[near]], fp[j[near]])
    return pa.table({"a": a, "b": b})


def linked(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints of ``fps`` (fp, distinct) within 3 bits; not every link is an edge."""
    return in_buckets(fps.select("fp").mapInArrow(_keyed, "key bigint, fp bigint"), _near, "a bigint, b bigint", "simhash-pairs")


def near_duplicates(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep``, ``fp`` and ``component_id`` of each row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links reach, links being fingerprints of at most 3 different bits. Null,
    empty and blank texts have fingerprint zero and link like any other. Repeated rows come out as they came in; null ids
    are never smallest, and a component of null ids only has a null id. Texts count whole, of any length; an empty table
    gives an empty one; other columns are ignored.
    """
    rows = staged(fingerprints(docs, keep), "simhash")
    return rows.join(_named(rows), "fp").select(*keep, "fp", "component_id")


def _named(rows: DataFrame) -> DataFrame:
    """(fp, root, component_id) of each fingerprint of ``rows`` (doc_id, fp): its component by least fingerprint and by least id."""
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(linked(distinct), "simhash-components").select(F.col("node").alias("fp"), "root")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = staged(named, "simhash-roots")
    ids = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-ids")
    return staged(named.join(ids, "root").select("fp", "root", "component_id"), "simhash-named")


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows of ``docs`` less near-duplicates: of each component the row with the least doc_id (null last), of ties one.

    Null and empty texts have one fingerprint and are copies of each other; texts of any length count whole; repeated rows
    are one; an empty table gives an empty one; other columns are left out.
    """
    rows = pick(docs, *columns)
    rows = rows.withColumn("_row", F.xxhash64(*columns))
    marked = staged(fingerprints(rows, ("doc_id", "_row")), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("_first")
    least = marked.groupBy("fp").agg(first)
    kept = least.join(_named(marked), "fp").groupBy("root").agg(F.min("_first").alias("_first")).select("_first.doc_id", "_first._row")
    same = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["_row"] == kept["_row"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_row"]).select(*columns)
