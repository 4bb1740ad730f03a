"""Filter interaction audit: what each filter does in every order of the filters.

A row's text gives a mask of the filters it fails. Rows are counted by part, mask and label before anything is
shuffled, so at most 128 counts of a part are left whatever its size. Each mask stands for a few big integers whose 600
fields (120 orders of five steps) hold what happens to such a row at each step; counts times integers, summed over a
part's masks, give all outcomes of the part in one number for each measure, which is then unpacked.
"""

from __future__ import annotations

from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import WORD, pick
from tapeline.session import staged

FILTERS = "ABCDE"
#: Bits of a field. A field counts rows of one part, which a signed 64-bit count holds, so no field runs into the next.
FIELD = 64
MEASURES = ("kept", "removed", "redundant", "unique_fails")


def text_failures(text: Column) -> list[Column]:
    """Whether a text (not null) fails A: under 100 words, B: few distinct words, C: many capitals, D: symbols."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic) of each row; bit k of the mask is set if the row fails filter k.

    The whole table's first row of a text is found by one combining aggregate over text digests, and met again by digest
    and doc_id together, so a text with very many copies is neither gathered nor joined in one task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = pick(docs, "doc_id", "text", "lang").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.sha2(text.cast("binary"), 256).alias("digest"), text.alias("text"),
    )
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(text_failures(F.col("text")))), F.lit(0))
    rows = staged(rows.select("doc_id", "part", F.unhex("digest").alias("digest"), mask.alias("mask")), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    same = rows["digest"].eqNullSafe(first["digest"]) & rows["doc_id"].eqNullSafe(first["doc_id"])
    rows = rows.join(first, same, "left").select(rows["doc_id"], "part", "mask", "first")
    marks = pick(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    rows = rows.join(marks, "doc_id", "left")
    copy = F.when(F.col("first").isNull(), 16).otherwise(0)
    return rows.select("part", (F.col("mask") + copy).alias("mask"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


@cache
def outcomes() -> tuple[list[tuple[str, int]], dict[str, list[int]]]:
    """(order, filter of the step) of each field, and for each measure the big integer of every mask."""
    fields = [("".join(order), FILTERS.index(f)) for order in permutations(FILTERS) for f in order]
    table = {m: [0] * (1 << len(FILTERS)) for m in MEASURES}
    for mask in range(1 << len(FILTERS)):
        gone = False
        for at, (_, f) in enumerate(fields):
            gone = gone and at % len(FILTERS) != 0
            fails, one = bool(mask >> f & 1), 1 << FIELD * at
            if fails:
                table["redundant" if gone else "removed"][mask] += one
            if mask == 1 << f:
                table["unique_fails"][mask] += one
            gone = gone or fails
            if not gone:
                table["kept"][mask] += one
    return fields, table


def unpack(total: int, fields: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(fields * FIELD // 8, "little"), "<u8").astype(np.int64)


OUTCOMES = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def _steps(counts: pa.Table) -> pa.Table:
    """All steps of one part from its counts: a row for each mask and pair of labels."""
    fields, table = outcomes()
    totals = dict.fromkeys((*MEASURES, "good_lost", "toxic_lost"), 0)
    for row in counts.to_pylist():
        for m in MEASURES:
            totals[m] += row["n"] * table[m][row["mask"]]
        totals["good_lost"] += row["n"] * row["good"] * table["removed"][row["mask"]]
        totals["toxic_lost"] += row["n"] * row["toxic"] * table["removed"][row["mask"]]
    out = {m: unpack(t, len(fields)) for m, t in totals.items()}
    step_filter = np.array([f for _, f in fields])
    over_orders = np.array([out["removed"][step_filter == f].sum() for f in range(len(FILTERS))])
    return pa.table({
        "part": pa.array([counts.column("part")[0].as_py()] * len(fields)), "filter_order": pa.array([o for o, _ in fields]),
        "step": pa.array(np.arange(len(fields), dtype=np.int32) % len(FILTERS) + 1), **{m: pa.array(v) for m, v in out.items()}, "shapley": pa.array(over_orders[step_filter]),
    })


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each part (a lang value; null is the empty string), order of the filters and step: counts of the part's rows.

    ``kept`` after the step, ``removed`` there, ``redundant`` (fail the step's filter but were removed before),
    ``unique_fails`` (fail this filter alone), ``good_lost`` and ``toxic_lost`` (removed there, labelled so) and
    ``shapley`` (removed by the step's filter, summed over all orders). ``docs`` needs doc_id, text and lang, ``labels``
    doc_id, quality and toxic; other columns are ignored.

    Null and empty texts are the same text, without words. A row fails E if a smaller doc_id has its text; rows with the
    same doc_id do not fail it through each other, and a null doc_id is larger than all others. Repeated rows count each for itself.
    A doc_id with several labels has each that one of them states; unlabelled rows and null ids have none. An empty table has no
    parts. The sum over a part's orders (``shapley``) leaves 64 bits only beyond 7 * 10^16 rows.
    """
    counts = failures(docs, labels).groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("part").applyInArrow(_steps, OUTCOMES)
