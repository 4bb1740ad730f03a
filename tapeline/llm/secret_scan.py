"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

A candidate is a maximal run of at least 20 characters that keys are written in, without the names and '=' before a value
of that length. Each run in it of one character class (hex, alphanumeric, base64) is scanned with the window and the entropy
that a random key of that class passes. Entropy is held as the sum of n log n over the window's character counts, so a step
of the window changes two terms. Windows above the limit merge to spans. Spans with an allowed word, runs of an allowed form
(placeholders, paths, dates, UUIDs) and spans without digits or without letters are left out.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import bound_batches, pick

# The base patterns and their least lengths, in the order in which kinds are listed.
_either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
_KEYWORD = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"({_KEYWORD})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "entropy")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Every access, hex and entropy span lies in such a run.
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{20,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: A name and its '=', before a value that a window fits in.
NAME = re.compile(r"[-_/]*(?:[A-Za-z]+[0-9]{0,4}[-_/]+)*[A-Za-z]+[0-9]{0,4}[-_/]*=+(?=[A-Za-z0-9+/_=-]{20})")
#: Character class: its runs, window, least bits per character of a window. A run shorter than the window is one window.
CLASSES = (
    ("hex", re.compile(r"[0-9a-f-]{20,}|[0-9A-F-]{20,}"), 24, 3.2),
    ("alphanumeric", re.compile(r"[A-Za-z0-9]{20,}"), 20, 3.75),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 20, 3.85),
)
UUID = re.compile(r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F])")
#: Strings that hold one of these words, or have one of these forms as a whole, are no secrets. A short word says nothing in a
#: string so long that it is there by chance (more than once in a thousand, with 32 characters to choose from).
ALLOWED_WORDS = ("example", "sample", "placeholder", "changeme", "xxxx", "abcdef", "0123456", "1234567", "http", "www")
ALLOWED_FORMS = re.compile(
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}|[0-9_/=+-]+|[A-Za-z_/=+-]+|[A-Za-z]+(?:[-_/][A-Za-z]+)*[-_/]?[0-9]{0,4}"
)


def hot_windows(text: str, width: int, bits: float) -> list[tuple[int, int]]:
    """Merged ranges of the windows of ``width`` characters whose entropy is at least ``bits`` per character."""
    term = [0.0] + [n * math.log2(n) for n in range(1, width + 2)]  # a step adds a character before one leaves
    limit = width * (math.log2(width) - bits) + 1e-9
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        total += term[n + 1] - term[n]
        counts[c] = n + 1
        if i >= width:
            old = text[i - width]
            n = counts[old]
            total += term[n - 1] - term[n]
            counts[old] = n - 1
        if i >= width - 1 and total <= limit:
            lo, hi = i - width + 1, i + 1
            if spans and lo <= spans[-1][1]:
                spans[-1] = (spans[-1][0], hi)
            else:
                spans.append((lo, hi))
    return spans


def allowed(text: str) -> bool:
    low = text.lower()
    return any(w in low and len(text) * 1000 <= 32 ** len(w) for w in ALLOWED_WORDS) or ALLOWED_FORMS.fullmatch(text) is not None


def entropy_spans(word: str) -> list[tuple[int, int]]:
    """Merged spans of a candidate that are random enough for the character class of some run in it."""
    start = 0
    while m := NAME.match(word, start):
        start = m.end()
    if ALLOWED_FORMS.fullmatch(word, start):
        return []
    known = [m.span() for m in UUID.finditer(word, start)]
    spans: list[tuple[int, int]] = []
    for _, runs, width, bits in CLASSES:
        for run in runs.finditer(word, start):
            for at, end in _between(run.start(), run.end(), known):
                if end - at < 20 or ALLOWED_FORMS.fullmatch(word, at, end):
                    continue
                for lo, hi in hot_windows(word[at:end], min(width, end - at), bits):
                    part = word[at + lo : at + hi]
                    if any(c.isdigit() for c in part) and any(c.isalpha() for c in part) and not allowed(part):
                        spans.append((at + lo, at + hi))
    merged: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def _between(lo: int, hi: int, known: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What ``known``, sorted spans that do not overlap, leave of a range."""
    for a, b in known[bisect.bisect_right(known, lo, key=lambda s: s[1]) :]:
        if a >= hi:
            break
        yield lo, a
        lo = b
    yield lo, hi


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    hot = []
    for run in RUN.finditer(text):
        at, body = run.start(), run.group()
        for kind, form in (("access", ACCESS), ("hex", HEX)):
            found += [(kind, at + m.start(), at + m.end()) for m in form.finditer(body) if m.end() - m.start() >= LEAST[kind]]
        for m in CANDIDATE.finditer(body):
            hot += [(at + m.start() + lo, at + m.start() + hi) for lo, hi in entropy_spans(m.group())]
    # a hot span inside a base span says nothing new; of the base spans that start no later, the one that ends last decides
    base, k, last = sorted((a, b) for _, a, b in found), 0, -1
    for lo, hi in hot:
        while k < len(base) and base[k][0] <= lo:
            last, k = max(last, base[k][1]), k + 1
        if last < hi:
            found.append(("entropy", lo, hi))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
MASK = "[secret]"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for lo in range(0, batch.num_rows, 256):
            rows = batch.slice(lo, 256)
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in find_secrets(t or "")] for t in rows.column(at).to_pylist()]
            keep = [i for i in range(rows.num_columns) if i != at]
            yield pa.record_batch([*(rows.column(i) for i in keep), pa.array(spans, _SPAN)], [*(rows.schema.names[i] for i in keep), "spans"])


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, n_chars = batch.schema.get_field_index("text"), batch.schema.get_field_index("n_chars")
        for lo in range(0, batch.num_rows, 256):
            rows = batch.slice(lo, 256)
            old = rows.column(at).to_pylist()
            new = [None if t is None else masked(t, find_secrets(t)) for t in old]
            lengths = [n if a == b else len(b) for n, a, b in zip(rows.column(n_chars).to_pylist(), old, new)]
            columns = list(rows.columns)
            columns[at], columns[n_chars] = pa.array(new, pa.string()), pa.array(lengths, pa.int64())
            yield pa.record_batch(columns, rows.schema.names)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping or touching spans replaced by one mask."""
    out, at, until = [], 0, -1
    for _, lo, hi in sorted(spans, key=lambda s: s[1:]):
        if lo > until:
            out += [text[at:lo], MASK]
        at = until = max(until, hi)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``spans`` (kind, start, end in code points) of each row of ``docs``.

    Null and empty texts have no spans; each row is scanned for itself, so repeated rows and null ids come out as they
    came in; texts of any length are scanned whole; an empty table gives an empty one; other columns are ignored.
    """
    rows = bound_batches(pick(docs, *keep, "text")).withColumn("text", F.col("text").cast("string"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_scan, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), f"spans {SPANS}"]))


def redact(docs: DataFrame) -> DataFrame:
    """The rows of documents with every secret masked; n_chars follows.

    Null and empty texts stay as they are, and so do rows with other nulls and repeated rows, each for itself; texts of any length are
    scanned whole; an empty table gives an empty one; columns beyond those of documents are left out.
    """
    rows = bound_batches(pick(docs, "doc_id", "text", "lang", "source", "n_chars")).withColumn("n_chars", F.col("n_chars").cast("bigint"))
    return rows.mapInArrow(_mask, rows.schema)


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
