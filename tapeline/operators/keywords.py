"""Keyword extraction and keyword statistics. Dictionaries are parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions import constants
from tapeline.functions.text import occurrences
from tapeline.functions.times import statistics_time
from tapeline.operators.scaling import once


def item_text(items: DataFrame) -> Column:
    return F.concat(F.coalesce(F.col("title"), F.lit("")), F.lit(" "), F.coalesce(F.col("content"), F.lit("")))


def extract_keywords(
    text: Column, top_n: int = 10, min_length: int = 2, plates: Mapping[str, Sequence[str]] = constants.PLATE_KEYWORDS
) -> Column:
    """Most frequent dictionary keywords of a text; ties keep dictionary order.

    A keyword listed in two plates is counted once per plate.
    """
    times: dict[str, int] = {}
    for words in plates.values():
        for w in words:
            if len(w) >= min_length:
                times[w] = times.get(w, 0) + 1
    cells = [
        F.struct((-occurrences(text, w) * n).alias("c"), F.lit(i).alias("i"), F.lit(w).alias("w")) for i, (w, n) in enumerate(times.items())
    ]
    found = F.filter(F.array(*cells), lambda x: x["c"] < 0)
    return F.coalesce(F.transform(F.slice(F.array_sort(found), 1, top_n), lambda x: x["w"]), F.array().cast("array<string>"))


def classify_plates(keywords: Column, plates: Mapping[str, Sequence[str]] = constants.PLATE_KEYWORDS) -> Column:
    """Plates that own any of the keywords, alphabetically."""
    cells = [F.when(F.arrays_overlap(keywords, F.array(*[F.lit(w) for w in plates[p]])), F.lit(p)) for p in sorted(plates)]
    return F.filter(F.array(*cells), lambda x: x.isNotNull())


def analyze(items: DataFrame, top_n: int = 10, plates: Mapping[str, Sequence[str]] = constants.PLATE_KEYWORDS) -> DataFrame:
    """Adds ``keywords`` and ``plates``; each text is put together and searched once, whatever is done with either."""
    df = once(items, {"_text": item_text(items)})
    df = once(df, {"keywords": extract_keywords(F.col("_text"), top_n, plates=plates)}).drop("_text")
    return once(df, {"plates": classify_plates(F.col("keywords"), plates)})


def keyword_frequency(analyzed: DataFrame) -> DataFrame:
    """Number of items that list each keyword."""
    return analyzed.select(F.explode("keywords").alias("keyword")).groupBy("keyword").agg(F.count(F.lit(1)).alias("n_items"))


def plate_distribution(analyzed: DataFrame) -> DataFrame:
    return analyzed.select(F.explode("plates").alias("plate")).groupBy("plate").agg(F.count(F.lit(1)).alias("n_items"))


def time_range(items: DataFrame, time: str = "publish_time") -> DataFrame:
    t = statistics_time(time)
    return items.groupBy().agg(F.min(t).alias("start"), F.max(t).alias("end"))


def high_frequency_topics(analyzed: DataFrame, window_hours: int = 1, threshold: int = 5, time: str = "publish_time") -> DataFrame:
    """Keywords above the threshold: plain counts when the span fits the window, else counts per window."""
    span = time_range(analyzed, time).select(((F.col("end") - F.col("start")).cast("interval second").cast("decimal(20,6)") / 3600).cast("double"))
    hours = span.scalar()
    counts = keyword_frequency(analyzed).withColumn("_hours", hours)
    rate = F.col("n_items") / F.greatest(F.lit(1.0), F.col("_hours")) * window_hours
    cond = F.when(F.col("_hours") <= window_hours, F.col("n_items") > threshold).otherwise(rate > threshold)
    return counts.where(cond).drop("_hours")


def keyword_plates(plates: Mapping[str, Sequence[str]] = constants.PLATE_KEYWORDS) -> dict[str, list[str]]:
    """Reverse index of the dictionary: keyword to its plates."""
    out: dict[str, list[str]] = {}
    for p, words in plates.items():
        for w in words:
            out.setdefault(w, []).append(p)
    return out
