"""Packing token sequences: concatenate and cut.

Pass one tokenizes and writes, for each document, its ids and where they start inside its partition. The partitions'
totals, one number each, are summed to offsets. Pass two cuts the one long sequence that this describes at multiples of
the window; a document that crosses a boundary leaves a piece on either side. Nothing is shuffled and nothing padded but
the end of the last window. The written table fixes the order, so a task that runs again gives the same pieces.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import bound_batches, pick
from tapeline.session import staged

WINDOW = 4096
#: Words whose ids a worker remembers at most: those of late, and as many that were asked for before them.
REMEMBERED = 600_000
_WORDS: dict[str, WordIds] = {}


class WordIds(dict):
    """Ids of words cut at ASCII white space, which this kind of tokenizer never joins or keeps.

    Most words come again, so their ids are remembered as bytes. Latin letters with ASCII signs after them are two pieces
    for the tokenizer: the letters go to the model straight and are remembered for themselves, and so are the signs; both together are
    not. All other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.before: dict[bytes, bytes] = {}
        self.spelled: dict[bytes, bytes] = {}  # Latin letters; all other words are the dictionary's own
        self.spelled_before: dict[bytes, bytes] = {}
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.kind = "H" if self.whole.get_vocab_size() <= 65536 else "I"
        self.split_safe = _split_safe(self.whole)
        self.plain = self.split_safe and _splits_words(self.whole)
        # the printable stand-ins that byte-level models have for bytes
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.shown = dict(zip(shown, map(chr, shown))) | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in shown)}
        # the model on many words at once: the last piece of each, and no other, bears the suffix
        suffix = getattr(self.model, "end_of_word_suffix", None) if self.plain else None
        self.lasts = None
        if suffix:
            self.bare = Tokenizer(self.model)
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocabulary = self.whole.get_vocab()
            self.lasts = np.zeros(1 + max(vocabulary.values()), bool)
            self.lasts[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True

    def _shown(self, word: bytes) -> str | None:
        """What the model takes for a word of Latin letters without combining marks, else None."""
        if word.isalpha():  # ASCII letters
            shown = word.decode()
            return shown if shown.islower() else None
        text = word.decode()
        if not text.isalpha() or max(text) >= "ɐ" or "İ" in text or any("A" <= c <= "Z" for c in text):
            return None
        return text.lower().encode().decode("latin-1").translate(self.shown)

    def _letters(self, word: bytes) -> bytes | None:
        """The model's own ids for a word of Latin letters without combining marks, else None."""
        ids = self.spelled.get(word) or self.spelled_before.get(word)
        if ids is None and (shown := self._shown(word)):
            ids = array(self.kind, [t.id for t in self.model.tokenize(shown)]).tobytes()
        if ids and len(word) <= 64:
            self.spelled[word] = ids
        return ids

    def _signed(self, word: bytes) -> bytes | None:
        """Ids of letters with signs after them, else None."""
        body = word.rstrip(SIGNS)
        ids = self._letters(body) if body else None
        return ids + self[word[len(body) :]] if ids else None

    def _age(self) -> None:
        """Forgets what was not asked for of late."""
        if 2 * (len(self) + len(self.spelled)) >= REMEMBERED:
            self.before, self.spelled_before, self.spelled = dict(self), self.spelled, {}
            self.clear()

    def __missing__(self, word: bytes) -> bytes:
        ids = None
        self._age()
        if self.plain and word:
            ids = self._letters(word) if word[-1] not in SIGNS else self._signed(word)
        if ids is None:
            ids = self.before.get(word)
            if ids is None:
                ids = array(self.kind, self.whole.encode(word.decode(), add_special_tokens=False).ids).tobytes()
            if len(word) <= 64:
                self[word] = ids
        return ids

    def of_each(self, words: pa.Array) -> list[bytes]:
        """Ids of different words. The letters among them, signs after them left out, that are not known yet go to the model together."""
        whole = _bytes(words)
        if self.lasts is None:
            return [self[w] for w in whole]
        self._age()
        bodies = _bytes(pc.ascii_rtrim(words, SIGNS.decode()))
        ids = list(map(self.spelled.get, bodies))
        unknown = [i for i, known in enumerate(ids) if known is None]
        self._spell({bodies[i] for i in unknown if len(bodies[i]) <= 64})
        for i in unknown:
            ids[i] = self.spelled.get(bodies[i])
        return [self[w] if known is None else known if len(w) == len(b) else known + self[w[len(b) :]] for w, b, known in zip(whole, bodies, ids)]

    def _spell(self, words: set[bytes]) -> None:
        fresh: dict[bytes, str] = {}
        for word in words:
            if ids := self.spelled_before.get(word):
                self.spelled[word] = ids
            elif word and (shown := self._shown(word)):
                fresh[word] = shown
        asked = list(fresh)
        for lo in range(0, len(asked), 20_000):
            own = asked[lo : lo + 20_000]
            got = np.array(self.bare.encode_batch_fast([" ".join([fresh[w] for w in own])], add_special_tokens=False)[0].ids, "<u2" if self.kind == "H" else "<u4")
            ends = np.flatnonzero(self.lasts[got]) + 1
            if len(ends) == len(own) and ends[-1] == len(got):  # else each word is asked for itself
                packed, at = got.tobytes(), (got.itemsize * ends).tolist()
                self.spelled.update(zip(own, [packed[x:y] for x, y in zip([0, *at], at)]))


def _bytes(values: pa.Array) -> list[bytes]:
    return values.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


#: ASCII signs; a run of them after letters is one piece for the tokenizer.
SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def _splits_words(tokenizer) -> bool:
    """Whether letters, and signs after them, are tokenized apart and in lower case."""
    ids = lambda s: tokenizer.encode(s, add_special_tokens=False).ids
    tries = ("word", "straße", "xqzv", "élan")
    try:
        model = lambda s: [t.id for t in tokenizer.model.tokenize(s)]
        apart = all(ids(f"{w.capitalize()}{s} {w}.") == [*ids(w), *ids(s), *ids(w), *ids(".")] for w in tries for s in (",", "'", ",%%%", "'-\"", "***"))
        return apart and ids("xqzv") == model("xqzv")
    except Exception:  # noqa: BLE001  models without this call
        return False


def _split_safe(tokenizer) -> bool:
    ids = lambda s: tokenizer.encode(s, add_special_tokens=False).ids
    return ids("one two\n three") == [*ids("one"), *ids("two"), *ids("three")]


def word_ids(path: str) -> WordIds:
    """The worker's own memory of this tokenizer."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def _cased(words: WordIds, text: bytes) -> bool:
    """Whether a text must keep its case. Composition comes before lower case: some letters compose with a mark (U+0300 to U+036F)
    in one case only. Special tokens are found before both."""
    return not words.plain or b"<|" in text or b"\xcc" in text or b"\xcd" in text


def token_ids(path: str, text: bytes) -> bytes:
    """Ids of a whole text as packed unsigned 16-bit numbers (32-bit for vocabularies beyond)."""
    words = word_ids(path)
    if not words.split_safe:
        return array(words.kind, words.whole.encode(text.decode(), add_special_tokens=False).ids).tobytes()
    return b"".join(map(words.__getitem__, (text if _cased(words, text) else text.lower()).split()))


def ids_of_texts(path: str, texts: list[bytes], end_id: int) -> tuple[pa.Array, np.ndarray]:
    """Ids of each text as ``token_ids`` gives them, ``end_id`` last, and how many they are.

    Each different word of the texts is looked up once; Arrow splits the texts and puts the ids together.
    """
    words = word_ids(path)
    kind = np.dtype("<u2" if words.kind == "H" else "<u4")
    if words.split_safe:
        cut = pc.ascii_split_whitespace(pa.array([t if _cased(words, t) else t.lower() for t in texts], pa.binary()).view(pa.string()))
        coded = cut.values.dictionary_encode()
        got = pa.array(words.of_each(coded.dictionary), pa.binary()).take(coded.indices)
        ends = np.frombuffer(got.buffers()[1], np.int32)[: len(got) + 1][cut.offsets.to_numpy()] // kind.itemsize
        ids = np.frombuffer(got.buffers()[2] or b"", kind)[: ends[-1]]
    else:
        each = [token_ids(path, t) for t in texts]
        ids, ends = np.frombuffer(b"".join(each), kind), np.cumsum([0, *(len(i) // kind.itemsize for i in each)])
    ids = np.insert(ids, ends[1:], end_id)
    ends = ends + np.arange(len(ends))
    places = (kind.itemsize * ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(ids.tobytes())]), np.diff(ends)


#: Bytes of texts whose words are looked up together; a longer text is alone.
TOGETHER = 8_000_000


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive rows, each run at most ``TOGETHER`` bytes or one row."""
    lo = held = 0
    for i, size in enumerate(sizes.tolist()):
        if held + size > TOGETHER and i > lo:
            yield lo, i
            lo, held = i, 0
        held += size
    if lo < len(sizes):
        yield lo, len(sizes)


TOKENS = "doc_id bigint, ids binary, n bigint, _part int, _start bigint"


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Ids of each document, ``end_id`` last, and how many ids its partition has before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).fill_null(b"")
            for lo, hi in _runs(pc.binary_length(texts).to_numpy()):
                rows, own = batch.slice(lo, hi - lo), texts.slice(lo, hi - lo)
                ids, n = ids_of_texts(path, _bytes(own), end_id)
                start = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.record_batch([rows.column(0), ids, pa.array(n, pa.int64()), pa.array(np.full(len(n), part, np.int32)), pa.array(start, pa.int64())], ["doc_id", "ids", "n", "_part", "_start"])

    return bound_batches(pick(docs, "doc_id", "text")).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, TOKENS)


PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                doc, ids, n, at = (batch.slice(lo, 256).column(i).to_pylist() for i in range(4))
                out: list[tuple] = []
                for d, packed, total, first in zip(doc, ids, n, at):
                    wide = np.frombuffer(packed, "<u2" if len(packed) == 2 * total else "<u4").astype("<u4").tobytes()
                    pos = 0
                    while pos < total:
                        seq, off = divmod(first + pos, window)
                        k = min(total - pos, window - off)
                        out.append((d, pos, k, wide[4 * pos : 4 * (pos + k)], total, seq, off))
                        pos += k
                    if len(out) >= 4096:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in PIECES.split(", ")])


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 2) -> DataFrame:
    """Pieces of documents in full windows of ``window`` ids; each id, the end id included, lies in one piece.

    ``docs`` needs doc_id and text. A piece has its document's id, how many of the document's ids come before it, its
    length, its ids (unsigned 32-bit, little-endian), the document's id count, the window and the place there. Null and
    empty texts are one end id; repeated rows and rows with a null doc_id are packed each for itself; an empty table
    gives no pieces; other columns are ignored. Documents follow in the order of the input's partitions.
    """
    rows = staged(tokenized(docs, tokenizer, end_id), "tokens", compression="zstd")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition of the input, so it can go to every task
    bases = rows.groupBy("_part").agg(F.sum("n").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    placed = rows.join(F.broadcast(bases), "_part").select("doc_id", "ids", "n", (F.col("_base") + F.col("_start")).alias("at"))
    return placed.mapInArrow(_cut(window), PIECES)
