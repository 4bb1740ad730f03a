"""Removal of repeated substrings: every byte that a string of ``length`` bytes covers which also starts earlier.

1. Anchors. In each window of ``length`` bytes the ``ANCHOR``-byte string with the least hash is the window's anchor. It
   depends on the window's bytes alone, so equal windows have equal anchors at equal places, and the windows of one anchor
   are a run. A row per run has the hash of the anchor and of the run's bytes. Runs that occur earlier in the same batch of
   texts are settled on the spot and need not travel.
2. The rows meet by anchor, in the order of documents. A run whose bytes an earlier run has is repeated as a whole. One
   run for each different content stays; where an anchor has several, some of their windows may be equal.
3. Those contexts are cut from the texts and meet by anchor again. They are trimmed to what another context of the anchor
   shares, and the suffixes of what is left are ordered by linear grouping (``suffixes``). Equal windows are neighbours
   in that order; all but the earliest are repeated. Where more than ``CELL`` contexts are left they are taken ``CELL`` at a
   time, and the windows that are new in their cell meet by their own hash. Only up to ``TRIMMED`` cells of one anchor
   are held for trimming; beyond that all windows that are new in their cell meet so.
4. The repeated windows of each document are joined to its text and merged to spans.

Texts travel compressed. Which document is earlier is decided by doc_id, null last, then by a hash of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import bound_batches, pick
from tapeline.llm.suffixes import suffix_order
from tapeline.session import staged

LENGTH = 100
ANCHOR = 32
CELL, TRIMMED = 4096, 16
#: Texts are taken up to this many bytes at a time; longer ones in blocks that overlap by less than a window.
BATCH = 8 << 20
BLOCK = 1 << 20
_PLACE = np.uint64(BLOCK - 1)
_U = np.uint64
_RANDOM = np.random.default_rng(29)
_ODD = _RANDOM.integers(0, 1 << 63, 8, dtype=np.uint64) | _U(1)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(int(_ODD[4]))
_INVERSE = _powers(pow(int(_ODD[4]), -1, 1 << 64))


def _string_hashes(b: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes (a multiple of 8) from each place on."""
    padded = np.concatenate((b, np.zeros(8, np.uint8)))
    words = np.ndarray((len(b),), np.dtype("<u8"), padded.data, 0, (1,))
    m = len(b) - size + 1
    h = words[:m] * _ODD[0]
    for at in range(8, size, 8):
        h ^= h >> _U(29)
        h += words[at : at + m]
        h *= _ODD[1 + at // 8 % 3]
    h ^= h >> _U(32)
    return h * _ODD[5]


def runs(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """For each run of windows of one anchor: hash of the anchor, of the run's bytes, first window, windows, bytes before the anchor."""
    got = [_block_runs(text[lo : lo + BLOCK], length, lo) for lo in range(0, max(1, len(text) - length + 1), BLOCK - length + 1)]
    return tuple(map(np.concatenate, zip(*got)))


def _block_runs(text: bytes, length: int, base: int) -> tuple[np.ndarray, ...]:
    if len(text) < length:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    b = np.frombuffer(text, np.uint8)
    h = _string_hashes(b, ANCHOR)
    least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    span, width = 1, length - ANCHOR + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: span - width], least[width - span :])
    place = (least & _PLACE).astype(np.int64)
    lo = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    hi = np.concatenate((lo[1:], [len(place)]))
    at = place[lo]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _POWER[: len(b)], dtype=np.uint64)))
    content = (sums[hi - 1 + length] - sums[lo]) * _INVERSE[lo]
    content ^= (hi - lo).astype(np.uint64) * _ODD[6] ^ (at - lo).astype(np.uint64) * _ODD[7]
    return h[at], content, lo + base, hi - lo, at - lo


def _key(doc: DataFrame) -> DataFrame:
    """(doc_id, rid, text as bytes): rid tells documents with one id apart."""
    rows = bound_batches(pick(doc, "doc_id", "text")).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("rid"), F.col("text").cast("binary").alias("text"))


RUN = "anchor bigint, content bigint, doc_id bigint, rid bigint, lo bigint, n int, shift int, settled boolean"


def _anchored(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            ids, rids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, text in enumerate(batch.column(2)):
                text = text.as_buffer().to_pybytes()
                if len(text) >= length:
                    held.append((ids[i], rids[i], *runs(text, length)))
                    size += len(text)
                if size >= BATCH:
                    yield from _settle(held)
                    held, size = [], 0
        if held:
            yield from _settle(held)

    return run


def _settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of some texts; those whose content an earlier row has are settled."""
    held = list({t[:2]: t for t in held}.values())
    held.sort(key=lambda t: (t[0] is None, t[0] or 0, t[1]))
    count = [len(t[4]) for t in held]
    anchor, content, lo, n, shift = (np.concatenate([t[i] for t in held]) for i in range(2, 7))
    order = np.lexsort((np.arange(len(lo)), content, anchor))
    a, c = anchor[order], content[order]
    settled = np.zeros(len(lo), bool)
    settled[order[1:]] = (a[1:] == a[:-1]) & (c[1:] == c[:-1])
    of = np.repeat(np.arange(len(held)), count)
    ids, rids = pa.array([t[0] for t in held], pa.int64()), pa.array([t[1] for t in held], pa.int64())
    for at in range(0, len(lo), 20_000):
        s = slice(at, at + 20_000)
        doc = pa.array(of[s])
        yield pa.record_batch(
            [pa.array(anchor[s].view(np.int64)), pa.array(content[s].view(np.int64)), ids.take(doc), rids.take(doc), pa.array(lo[s]), pa.array(n[s].astype(np.int32)), pa.array(shift[s].astype(np.int32)), pa.array(settled[s])],
            ["anchor", "content", "doc_id", "rid", "lo", "n", "shift", "settled"],
        )


def _whole_keys(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted batches cut so that all rows of a key are together, which the caller can bear."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        if not rows.num_rows:
            continue
        k = rows.column(key).to_numpy()
        cut = int(np.searchsorted(k, k[-1], "left"))
        if cut:
            yield rows.slice(0, cut).combine_chunks()
        held = rows.slice(cut).combine_chunks() if cut else rows
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _once(rows: pa.Table, before: tuple | None = None) -> pa.Table:
    """Sorted rows less those that repeat the document and place of the one before them: repeated rows of the input."""
    doc, rid, lo = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "rid", "lo"))
    new = np.ones(len(lo), bool)
    new[1:] = (lo[1:] != lo[:-1]) | (rid[1:] != rid[:-1]) | ((doc[1:] != doc[:-1]) & ~((doc[1:] != doc[1:]) & (doc[:-1] != doc[:-1])))
    if before is not None and len(lo):
        new[0] = (rows.column("doc_id")[0].as_py(), rid[0], lo[0]) != before
    return rows if new.all() else rows.take(pa.array(np.flatnonzero(new)))


PLACED = "doc_id bigint, rid bigint, lo bigint, n int, shift int, anchor bigint"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of (anchor, document, lo): repeated runs (anchor null), and one run for each content of anchors with several."""
    for rows in _whole_keys(batches, "anchor"):
        rows = _once(rows)
        anchor, content = rows.column("anchor").to_numpy(), rows.column("content").to_numpy()
        order = np.lexsort((np.arange(len(anchor)), content, anchor))
        a, c = anchor[order], content[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])))
        first = np.zeros(len(a), bool)
        first[order] = new
        group = np.cumsum(np.concatenate(([True], anchor[1:] != anchor[:-1]))) - 1
        several = np.bincount(group, first)[group] > 1
        keep = np.flatnonzero(~first | several)
        mark = pa.array(anchor[keep], pa.int64(), mask=~first[keep])
        out = rows.select(["doc_id", "rid", "lo", "n", "shift"]).take(pa.array(keep)).append_column("anchor", mark)
        yield from out.to_batches(max_chunksize=20_000)


CONTEXT = "anchor bigint, doc_id bigint, rid bigint, lo bigint, n int, shift int, bytes binary"


def _contexts(length: int):
    """The bytes of each run, and where in them the anchor is, from rows (doc_id, rid, text, runs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            ids, rids, texts, packed = (batch.column(i).to_pylist() for i in range(4))
            for doc_id, rid, text, own in zip(ids, rids, texts, packed):
                text = zstd.decompress(text)
                own.sort(key=lambda r: r["lo"])
                for at in range(0, len(own), 10_000):
                    part = own[at : at + 10_000]
                    cut = [text[r["lo"] : r["lo"] + r["n"] + length - 1] for r in part]
                    k = len(part)
                    yield pa.record_batch(
                        [pa.array([r["anchor"] for r in part]), pa.array([doc_id] * k, pa.int64()), pa.array([rid] * k, pa.int64()), pa.array([r["lo"] for r in part]), pa.array([r["n"] for r in part], pa.int32()), pa.array([r["shift"] for r in part], pa.int32()), pa.array(cut, pa.binary())],
                        ["anchor", "doc_id", "rid", "lo", "n", "shift", "bytes"],
                    )

    return run


REPEATED = "doc_id bigint, rid bigint, lo bigint, n int, w1 bigint, w2 bigint"


def _resolve(length: int, cell: int):
    """Repeated windows among the contexts of each anchor; windows of large groups that are new so far carry their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, last = None, 0, None  # rows of the last anchor; cells of it that are done, and where they end
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            if not rows.num_rows:
                continue
            a = rows.column("anchor").to_numpy()
            cut = int(np.searchsorted(a, a[-1], "left"))
            if cut:
                yield from resolved(_once(rows.slice(0, cut), last), part)
                part, last = 0, None
            held = _once(rows.slice(cut), last).combine_chunks()
            while held.num_rows > (most := TRIMMED * cell):
                yield from resolved(held.slice(0, most), part, True)
                last = tuple(held.column(c)[most - 1].as_py() for c in ("doc_id", "rid", "lo"))
                held, part = held.slice(most), part + 1
        if held is not None and held.num_rows:
            yield from resolved(_once(held, last), part)

    def resolved(rows: pa.Table, part: int, more: bool = False) -> Iterator[pa.RecordBatch]:
        """part: whether rows of the first anchor have gone before; more: whether others follow."""
        rows = rows.combine_chunks()
        anchor = rows.column("anchor").to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1], [True])))
        ids, rids = rows.column("doc_id"), rows.column("rid")
        n, lo, shift = (rows.column(c).to_numpy().astype(np.int64) for c in ("n", "lo", "shift"))
        data = rows.column("bytes").to_pylist()
        left, right = shared(data, shift, anchor)
        out: list[tuple] = []
        for g in range(len(cuts) - 1):
            s, e = int(cuts[g]), int(cuts[g + 1])
            whole = not more and not (g == 0 and part > 0)
            own = [i for i in range(s, e) if not whole or left[i] + ANCHOR + right[i] >= length]
            for at in range(0, len(own) if len(own) > 1 or not whole else 0, cell):
                out += _windows(data, shift, n, lo, left, right, own[at : at + cell], length, whole, len(own) > cell or not whole)
            if len(out) > 20_000:
                yield packed(out, ids, rids)
                out = []
        if out:
            yield packed(out, ids, rids)

    def packed(out: list[tuple], ids, rids) -> pa.RecordBatch:
        i, lo, n, w1, w2 = zip(*out)
        i = pa.array(i)
        flat = lambda c: c.take(i).combine_chunks() if isinstance(c, pa.ChunkedArray) else c.take(i)
        return pa.Table.from_arrays([flat(ids), flat(rids), pa.array(lo, pa.int64()), pa.array(n, pa.int32()), pa.array(w1, pa.int64()), pa.array(w2, pa.int64())], ["doc_id", "rid", "lo", "n", "w1", "w2"]).combine_chunks().to_batches()[0]

    return run


def shared(data: list[bytes], shift: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before, and after, the anchor each context has in common with some other one of its anchor, at most."""
    out = []
    for side in ([d[:s][::-1] for d, s in zip(data, shift.tolist())], [d[s + ANCHOR :] for d, s in zip(data, shift.tolist())]):
        size = np.fromiter(map(len, side), np.int64, len(side))
        wide = -(-max(1, int(size.max(initial=1))) // 8) * 8
        table = np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in side), np.uint8).reshape(len(side), wide)
        words = table.view(">u8")
        order = np.lexsort((*[words[:, k] for k in range(words.shape[1] - 1, -1, -1)], anchor))
        t, g = table[order], anchor[order]
        differ = t[1:] != t[:-1]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), wide)
        same[g[1:] != g[:-1]] = 0
        most = np.zeros(len(side), np.int64)
        most[1:] = same
        most[:-1] = np.maximum(most[:-1], same)
        back = np.empty(len(side), np.int64)
        back[order] = most
        out.append(np.minimum(back, size))
    return out[0], out[1]


def _windows(data, shift, n, lo, left, right, own: list[int], length: int, trim: bool, hashed: bool) -> list[tuple]:
    """(row, first window, windows, null, null) that are repeated in ``own``; if ``hashed``, also the others, one by one, with their hash."""
    parts, where, at = [], [], 0
    for i in own:
        s = int(shift[i])
        l, r = (int(left[i]), int(right[i])) if trim else (s, len(data[i]) - s - ANCHOR)
        # the anchor is common to all and takes one character
        piece = data[i][s - l : s].decode("latin-1") + "Ā" + data[i][s + ANCHOR : s + ANCHOR + r].decode("latin-1") + "ā"
        parts.append(piece)
        where.append((at, i, l, min(l, l + r + ANCHOR - length)))
        at += len(piece)
    text = "".join(parts)
    short = length - ANCHOR + 1
    start: list[tuple | None] = [None] * len(text)
    for base, i, l, last in where:
        w = int(shift[i]) - l  # number of the piece's first window in its run
        for k in range(max(0, -w), min(last + 1, int(n[i]) - w)):
            start[base + k] = (i, w + k)
    hits: dict[int, list[int]] = {}
    new: list[tuple] = []
    last_text, members = None, []

    def close() -> None:
        if not members:
            return
        members.sort()
        for i, w in members[1:]:
            hits.setdefault(i, []).append(w)
        if hashed:
            new.append(members[0])

    for p in suffix_order(text):
        if (here := start[p]) is None:
            continue
        body = text[p : p + short]
        if body != last_text:
            close()
            last_text, members = body, []
        members.append(here)
    close()
    out = []
    for i, ws in hits.items():
        ws.sort()
        begin = prior = ws[0]
        for w in [*ws[1:], None]:
            if w is None or w != prior + 1:
                out.append((i, int(lo[i]) + begin, prior - begin + 1, None, None))
                begin = w
            prior = w
    for i, w in new:
        h = xxhash.xxh3_128_intdigest(data[i][w : w + length])
        out.append((i, int(lo[i]) + w, 1, (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)))
    return out


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows in order of (hash, document, place): all but the first of each hash."""
    last = None
    for batch in batches:
        w = list(zip(batch.column("w1").to_pylist(), batch.column("w2").to_pylist()))
        keep = [i for i, x in enumerate(w) if x == (w[i - 1] if i else last)]
        last = w[-1] if w else last
        yield batch.take(pa.array(keep, pa.int64())).select(["doc_id", "rid", "lo", "n"])


def repeated_runs(docs: DataFrame, length: int = LENGTH, cell: int = CELL) -> DataFrame:
    """(doc_id, rid, lo, n): windows of documents (doc_id, rid, text) that start earlier as well, as runs of first window and number."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("rid"), F.col("lo")]
    rows = docs.mapInArrow(_anchored(length), RUN)
    # a settled run needs no partner: it goes to any partition, by its own content
    met = rows.repartition(F.when(F.col("settled"), F.xxhash64("content", "rid", "lo")).otherwise(F.col("anchor"))).sortWithinPartitions("settled", "anchor", *order)
    placed = staged(met.mapInArrow(_split_settled, PLACED), "substring-runs", "zstd")
    whole = placed.where("anchor IS NULL").select("doc_id", "rid", "lo", "n")

    several = placed.where("anchor IS NOT NULL").groupBy("doc_id", "rid").agg(F.collect_list(F.struct("anchor", "lo", "n", "shift")).alias("runs"))
    texts = _compressed(docs)
    same = texts["doc_id"].eqNullSafe(several["doc_id"]) & (texts["rid"] == several["rid"])
    cut = several.join(texts, same).select(several["doc_id"], several["rid"], "text", "runs").mapInArrow(_contexts(length), CONTEXT)
    # a run keeps all rows of an anchor in one task, sorted; it is read a cell at a time
    found = cut.repartition("anchor").sortWithinPartitions("anchor", *order).mapInArrow(_resolve(length, cell), REPEATED)
    found = staged(found, "substring-windows", "zstd")
    open_ = found.where("w1 IS NOT NULL").repartition("w1", "w2").sortWithinPartitions("w1", "w2", *order)
    return whole.unionByName(found.where("w1 IS NULL").select("doc_id", "rid", "lo", "n")).unionByName(open_.mapInArrow(_again, "doc_id bigint, rid bigint, lo bigint, n int"))


def _split_settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (settled, anchor, document, lo): the others are compared, and settled ones pass."""
    rest: list[pa.RecordBatch] = []

    def others() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = int(np.searchsorted(batch.column("settled").to_numpy(zero_copy_only=False), True))
            if k:
                yield batch.slice(0, k)
            if k < batch.num_rows:
                rest.append(batch.slice(k))
                return

    yield from _compare(others())
    for batch in chain(rest, batches):
        yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "rid", "lo", "n", "shift")), pa.nulls(batch.num_rows, pa.int64())], ["doc_id", "rid", "lo", "n", "shift", "anchor"])


def _compressed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            text = pa.array([zstd.compress(t) for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(1), text], ["doc_id", "rid", "text"])

    return docs.mapInArrow(run, "doc_id bigint, rid bigint, text binary")


def spans_of(lo: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans (start, end) of the bytes that the windows cover."""
    order = np.argsort(lo, kind="stable")
    start, end = lo[order], (lo + n + length - 1)[order]
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    return start[first], np.concatenate((reach[first[1:] - 1], reach[-1:]))


CLEANED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def _cleaned(length: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc_id, packed, own in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text, removed, spans = zstd.decompress(packed), 0, 0
                kept = text
                if own:
                    start, end = spans_of(np.array([r["lo"] for r in own]), np.array([r["n"] for r in own]), length)
                    removed, spans = int((end - start).sum()), len(start)
                    kept = b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(text)]))
                out.append((doc_id, len(text), removed, spans, hashlib.sha256(kept).hexdigest().encode() if digest else kept))
            if out:
                kinds = [pa.int64()] * 4 + [pa.binary()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [f.split()[0] for f in CLEANED.split(", ")])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, digest: bool = False, cell: int = CELL) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept of each row of ``docs`` (doc_id, text), texts taken as UTF-8 bytes.

    kept are the bytes that stay, or with ``digest`` their SHA-256 in hexadecimal. Null texts are empty. A string is
    earlier in a smaller doc_id, or earlier in the same text. Null ids come last, and texts that share an id go by a hash;
    rows that share both are one document and all get its result. Whole texts count, of any length; an empty table gives
    an empty one; other columns are ignored.
    """
    rows = _key(docs)
    found = repeated_runs(rows, length, cell).groupBy("doc_id", "rid").agg(F.collect_list(F.struct("lo", "n")).alias("runs"))
    texts = _compressed(rows)
    same = texts["doc_id"].eqNullSafe(found["doc_id"]) & (texts["rid"] == found["rid"])
    return texts.join(found, same, "left").select(texts["doc_id"], "text", "runs").mapInArrow(_cleaned(length, digest), CLEANED)
