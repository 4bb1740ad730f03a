"""Language identification with hyperdimensional profiles.

Each letter has a fixed random vector of +1 and -1, drawn from its code point. A letter's place in an n-gram is a cyclic
shift of its vector, and the product of the shifted vectors binds them to one n-gram vector. The n-gram vectors of a text,
added up with their counts, are its profile; the profiles of a language's texts, each divided by its length, add up to
the prototype. A text has the language whose prototype is nearest by cosine. The mean of the prototypes, which holds what
all languages share, is taken from both sides first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm.common import bound_batches, pick
from tapeline.session import staged

DIMENSION = 512
GRAM = 3
UNKNOWN = "und"
#: Labelled texts that the prototypes are learned from, for each language and in expectation: the bound of the sample.
LEARNED_TEXTS = 4000
_FOLD = np.zeros(0x110000, np.uint8)  # 0: not seen yet, 1: no letter, 2: letter
_BLOCK = 1 << 18


def _code_points(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points, and which of them are letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _FOLD[points]
    if not kinds.all():
        for c in np.unique(points[kinds == 0]).tolist():
            _FOLD[c] = 1 + chr(c).isalpha()
        kinds = _FOLD[points]
    return points, kinds == 2


def ended(text: str) -> str:
    return f"\0{text.lower()}\0"


def blocks_of(text: str, n: int = GRAM) -> Iterator[str]:
    """A long text as blocks whose n-grams are together those of the text; a block starts with the n - 1 last points of the one before."""
    text, carry, after = ended(text), "", True
    for lo in range(0, len(text), _BLOCK):
        points, letter = _code_points(text[lo : lo + _BLOCK])
        use = letter.copy()
        use[0] |= after
        use[1:] |= letter[:-1]
        after = bool(letter[-1])
        block = carry + np.where(letter, points, 0)[use].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
        yield block
        carry = block[max(0, len(block) - n + 1) :]


def grams(low: list[str], n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of lower-cased texts with their ends, packed 21 bits a letter, and which text each is of.

    Each run of other characters than letters, and either end, is one blank (code point 0).
    """
    points, letter = _code_points("".join(low))
    of = np.repeat(np.arange(len(low)), [len(t) for t in low])
    use = letter.copy()
    use[0] = True
    use[1:] |= letter[:-1] | (of[1:] != of[:-1])
    points, of = np.where(letter, points, 0)[use].astype(np.int64), of[use]
    size = len(points) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    packed = np.zeros(size, np.int64)
    for i in range(n):
        packed = (packed << 21) | points[i : size + i]
    inside = (of[:size] == of[n - 1 :]) & (packed != 0)
    return packed[inside], of[:size][inside]


class GramVectors:
    """n-gram vectors by bound and shifted letter vectors; a worker keeps those of frequent use."""

    KEPT = 20_000

    def __init__(self, dimension: int = DIMENSION, n: int = GRAM, seed: int = 11):
        self.dimension, self.n, self.seed = dimension, n, seed
        self.letter: dict[int, np.ndarray] = {}
        self.forget()

    def forget(self) -> None:
        self.known = self.at = np.zeros(0, np.int64)
        self.table = np.zeros((0, self.dimension), np.float32)

    def of_letter(self, point: int) -> np.ndarray:
        if (v := self.letter.get(point)) is None:
            v = np.random.default_rng([self.seed, point]).integers(0, 2, self.dimension).astype(np.int8) * 2 - 1
            if len(self.letter) < self.KEPT:
                self.letter[point] = v
        return v

    def of_gram(self, gram: int) -> np.ndarray:
        v = np.ones(self.dimension, np.int8)
        for i in range(self.n):
            v = v * np.roll(self.of_letter((gram >> 21 * i) & 0x1FFFFF), i)
        return v

    def columns(self, packed: np.ndarray) -> np.ndarray:
        """Rows of ``table`` for these n-grams."""
        k = np.searchsorted(self.known, packed)
        new = self.known[np.minimum(k, len(self.known) - 1)] != packed if len(self.known) else np.ones(len(packed), bool)
        if not new.any():
            return self.at[k]
        fresh = np.unique(packed[new])
        if len(self.known) + len(fresh) > self.KEPT and len(self.known):
            self.forget()
            return self.columns(packed)
        self.table = np.concatenate((self.table, np.array([self.of_gram(g) for g in fresh.tolist()], np.float32)))
        at = np.concatenate((self.at, np.arange(len(self.table) - len(fresh), len(self.table))))
        known = np.concatenate((self.known, fresh))
        order = np.argsort(known)
        self.known, self.at = known[order], at[order]
        return self.at[np.searchsorted(self.known, packed)]

    def profiles(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Profile of each text, divided by its number of n-grams (zero without letters), and that number."""
        out, sizes = np.zeros((len(texts), self.dimension), np.float32), np.zeros(len(texts), np.int64)
        # very long texts go block by block
        parts = ((i, b) for i, t in enumerate(texts) for b in (blocks_of(t, self.n) if len(t) > _BLOCK else (ended(t),)))
        for blocks in _together(parts):
            take, owner = len(blocks), np.array([i for i, _ in blocks])
            packed, of = grams([t for _, t in blocks], self.n)
            if not len(packed):
                continue
            used, col = _dense(self.columns(packed), len(self.table))
            counts = np.bincount(of * len(used) + col, minlength=take * len(used)).reshape(take, len(used)).astype(np.float32)
            table = self.table if len(used) == len(self.table) else self.table[used]
            np.add.at(out, owner, counts @ table)
            np.add.at(sizes, owner, np.bincount(of, minlength=take))
        np.divide(out, sizes[:, None], out=out, where=sizes[:, None] > 0)
        return out, sizes


def _together(parts: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    """Runs of blocks of up to ``_BLOCK`` characters, or one longer block."""
    run, chars = [], 0
    for part in parts:
        if run and (len(run) == 64 or chars + len(part[1]) > _BLOCK):
            yield run
            run, chars = [], 0
        run.append(part)
        chars += len(part[1])
    if run:
        yield run


def _dense(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that occur among ``index``, and the place of each entry among them."""
    there = np.bincount(index, minlength=size) > 0
    return np.flatnonzero(there), (np.cumsum(there) - 1)[index]


_VECTORS: dict[int, GramVectors] = {}


def _vectors(dimension: int) -> GramVectors:
    if dimension not in _VECTORS:
        _VECTORS[dimension] = GramVectors(dimension)
    return _VECTORS[dimension]


def drawn(labelled: DataFrame, texts: int = LEARNED_TEXTS, seed: int = 5) -> DataFrame:
    """The texts that are learned from, (lang, text), of (text, lang) with lang not null.

    A hash of the text decides which about ``texts`` different texts of each language they are; copies count once.
    """
    rows = bound_batches(pick(labelled, "text", "lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("_hash", F.xxhash64(F.lit(seed), "text"))
    share = rows.select("lang", "_hash").distinct().groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(texts)) / F.count(F.lit(1))).alias("_share"))
    take = F.pmod(F.col("_hash"), F.lit(1 << 30)) < F.col("_share") * (1 << 30)
    # a number for each language, where the model that every task gets has a vector for each
    taken = rows.join(F.broadcast(share), "lang").where(take)
    return taken.groupBy("lang", "_hash").agg(F.min("text").alias("text")).select("lang", "text")


def prototypes(labelled: DataFrame, dimension: int = DIMENSION, texts: int = LEARNED_TEXTS, seed: int = 5) -> tuple[list[str], np.ndarray]:
    """Languages in order, and a prototype row for each, from the texts ``drawn`` of (text, lang)."""
    return learn(drawn(labelled, texts, seed), dimension)


def different(labelled: DataFrame, seed: int = 5) -> DataFrame:
    """All texts with a language, (lang, text), of (text, lang); copies in one language count once."""
    rows = bound_batches(pick(labelled, "text", "lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return rows.groupBy("lang", F.xxhash64(F.lit(seed), "text").alias("_hash")).agg(F.min("text").alias("text")).select("lang", "text")


def learn(sample: DataFrame, dimension: int = DIMENSION) -> tuple[list[str], np.ndarray]:
    """Languages in order, and a prototype row for each, from all of (lang, text); texts without letters teach nothing.

    Partitions add up their own profiles first; there is one row for each language and partition after that.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            lang, text = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(text), 64):
                got, sizes = _vectors(dimension).profiles(text[lo : lo + 64])
                for one, v, n in zip(lang[lo : lo + 64], got, sizes):
                    if n:
                        sums[one] = sums.get(one, 0) + v.astype(np.float64)
        yield pa.record_batch([pa.array(sums, pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"])

    parts = sample.mapInArrow(add, "lang string, v array<double>").select("lang", F.posexplode("v"))
    added = parts.groupBy("lang", "pos").agg(F.sum("col").alias("v"))  # languages x dimension numbers: the model
    found: dict[str, np.ndarray] = {}
    for r in added.toLocalIterator():
        found.setdefault(r["lang"], np.zeros(dimension))[r["pos"]] = r["v"]
    names = sorted(found)
    matrix = np.array([found[k] / max(np.linalg.norm(found[k]), 1e-300) for k in names]).reshape(len(names), dimension)
    return names, matrix


def identify(docs: DataFrame, names: list[str], matrix: np.ndarray, keep: tuple[str, ...] = ("doc_id",), fit: bool = False) -> DataFrame:
    """The columns of ``keep``, ``lang_pred`` and ``score`` of each row of ``docs`` (text).

    With ``fit`` also ``variety``, the whole power of 2 of the number of different n-grams that would make a profile as
    long if all were as frequent, and ``near``, the part of the profile that all prototypes together account for (0 to 1).

    Score is the cosine with the nearest prototype, at least 0; ties go to the first name. Null texts, texts without a
    letter, and all texts if nothing was learned, get ``und`` and score 0. Repeated rows and null ids come out as they
    came in; texts of any length count whole; an empty table gives an empty one; other columns are ignored.
    """
    rows = bound_batches(pick(docs, *keep, "text")).toDF(*keep, "_text").withColumn("_text", F.col("_text").cast("string"))
    kinds, at = dict(rows.dtypes), len(keep)
    centre = matrix.mean(axis=0) if len(names) > 1 else np.zeros(matrix.shape[1])
    near = matrix - centre
    near = near / np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-300)
    _, spread, axes = np.linalg.svd(near, full_matrices=False)
    axes = axes[spread > 1e-6]  # a text in two learned languages is far from either prototype, but in their span

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                got, sizes = _vectors(matrix.shape[1]).profiles([t or "" for t in part.column(at).to_pylist()])
                got = got.astype(np.float64)
                length = np.linalg.norm(got, axis=1, keepdims=True)
                got = got / np.maximum(length, 1e-300) - centre
                got /= np.maximum(np.linalg.norm(got, axis=1, keepdims=True), 1e-300)
                known = (sizes > 0) & (len(names) > 0)
                cosine = got @ near.T if names else np.zeros((len(got), 1))
                best = cosine.argmax(axis=1)
                pred = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
                score = np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0.0)
                out = {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score)}
                if fit:
                    # vectors of n-grams are all but orthogonal, so a profile's square is the dimension by the number
                    variety = np.log2(np.clip(matrix.shape[1] / np.maximum(length[:, 0], 1e-9) ** 2, 1, 1 << 30)).astype(np.int32)
                    out |= {"variety": pa.array(variety), "near": pa.array(np.linalg.norm(got @ axes.T, axis=1))}
                yield pa.record_batch([*part.columns[:at], *out.values()], [*part.schema.names[:at], *out])

    added = ["lang_pred string", "score double", *(["variety int", "near double"] if fit else [])]
    return rows.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), *added]))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 when divided by 3. Null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: A text is in a learned language from this part of what all but ``LOW`` of the learned texts of its variety reach.
PART, LOW = 0.4, 0.01
#: Learned texts of one language and variety that a limit is derived from, at least.
LEAST_TEXTS = 20
#: Under 128 different n-grams, learned texts and noise are equally near, and none is left out.
LEAST_VARIETY = 7


def limits(sample: DataFrame, names: list[str], matrix: np.ndarray, least: int = LEAST_TEXTS) -> dict[str, dict[int, float]]:
    """Least ``near`` of a text in a learned language, by the language named for it and by variety, from (lang, text).

    A text of few different n-grams is far from every prototype in any language, so texts are compared with those of like
    variety. The language is the one found, not the label: wrong labels and mixed texts do not move a limit. A language
    and variety with fewer than ``least`` learned texts, or a variety below ``LEAST_VARIETY``, has no limit.
    """
    return limits_of(identify(sample, names, matrix, ("lang",), fit=True), least)


def limits_of(fits: DataFrame, least: int = LEAST_TEXTS) -> dict[str, dict[int, float]]:
    """``limits`` from (lang_pred, variety, near), a row for each learned text."""
    low = fits.where(F.col("lang_pred") != UNKNOWN).groupBy("lang_pred", "variety").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("near", LOW, 10_000).alias("low"))
    found: dict[str, dict[int, float]] = {}
    for r in low.where((F.col("n") >= least) & (F.col("variety") >= LEAST_VARIETY)).toLocalIterator():  # a number for each language and power of 2
        found.setdefault(r["lang_pred"], {})[r["variety"]] = PART * r["low"]
    return found


def speaks(docs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows of ``docs`` in a learned language: those with a letter whose ``near`` reaches the limit.

    Null texts and texts without letters go; rows with other nulls and repeated rows are judged each for itself, as wholes of any
    length; an empty table, and one without labels to learn from, gives an empty one; other columns are left out.

    Prototypes and limits come from all different texts with a language whose documents are not held out.

    A variety without a limit has that of the next lower one, as more n-grams bring a text nearer. Where there is none,
    which is for texts of few words and languages of few texts, too little is known to leave a text out, and it stays.
    """
    docs = pick(docs, *columns)
    names, matrix = learn(different(docs.where(~held_out(F.col("doc_id")))))
    learned = F.when(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull(), F.xxhash64(F.lit(5), "text"))
    marked = docs.withColumn("_learned", learned)
    rows = staged(identify(marked, names, matrix, (*columns, "_learned"), fit=True), "language-fits")
    # copies are judged alike, so any of them stands for a learned text
    once = rows.where(F.col("_learned").isNotNull()).groupBy("lang", "_learned").agg(*[F.max(c).alias(c) for c in ("lang_pred", "variety", "near")])
    enough = F.col("lang_pred") != UNKNOWN
    for name, by in limits_of(once).items():
        limit = F.lit(0.0)
        for variety in sorted(by):
            limit = F.when(F.col("variety") >= variety, by[variety]).otherwise(limit)
        enough = enough & ((F.col("lang_pred") != name) | (F.col("near") >= limit))
    return rows.where(enough).select(*columns)
