"""Small tables with everything that operators must bear."""

from __future__ import annotations

import random

WORDS = "the of and to in that with river stone light morning garden letters winter copper signal harbour window".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with nulls, blanks, repeats, ties and a very long text."""
    same = prose(1, 60)
    rows = [
        (1, same, "en", "a", 1), (2, same, "en", "a", 1), (2, same, "en", "a", 1), (3, None, "en", "a", None), (4, "", None, None, 0), (5, " \n\t ", "en", "b", 4),
        (None, prose(2, 40), "en", None, 2), (None, prose(2, 40), "en", None, 2), (None, None, None, None, None), (6, "12 34 !!", "en", "b", 8),
        (7, prose(3, 40_000), "en", "c", 9), (8, same.upper(), "en", "c", 1), (9, "naïve Ünïcode 日本語 \U0001f600 end", "xx", "d", 5),
    ]
    return rows + [(10 + k, prose(10 + k, 30 + k), "en", "abcd"[k % 4], 7) for k in range(20)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_docs(spark):
    """The rows, with extra columns whose names clash with the others in all but case."""
    rows = [(*r, 0, "x", "y") for r in odd_rows()]
    return spark.createDataFrame(rows, SCHEMA + ", c5 int, c6 string, c7 string").toDF("doc_id", "text", "lang", "source", "n_chars", "DOC_ID", "TEXT", "Lang")


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
