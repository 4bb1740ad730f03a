"""Market signals from social text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions import constants
from tapeline.functions.text import keyword_hits, one_line, stock_codes


def theme_tags(text: Column, patterns: Mapping[str, str] = constants.SOCIAL_THEME_PATTERNS) -> Column:
    """Themes whose pattern occurs, in dictionary order."""
    return F.array_compact(F.array(*[F.when(text.rlike("(?iu)" + p), F.lit(t)) for t, p in patterns.items()]))


def theme_keywords(text: Column, patterns: Mapping[str, str] = constants.SOCIAL_THEME_PATTERNS, per_theme: int = 8) -> Column:
    """Distinct sorted matches, the first ``per_theme`` of each theme."""
    found = [F.slice(F.regexp_extract_all(text, F.lit("(?iu)(" + p + ")"), F.lit(1)), 1, per_theme) for p in patterns.values()]
    return F.array_sort(F.array_distinct(F.filter(F.concat(*found), lambda x: x != "")))


def extract_signals(
    raw: DataFrame, patterns: Mapping[str, str] = constants.SOCIAL_THEME_PATTERNS, words: Mapping[str, Sequence[str]] = constants.SOCIAL_SIGNAL_WORDS
) -> DataFrame:
    """Themes, stocks, scores and labels of every fetched text; the whole text is read."""
    text = F.coalesce("raw_text", F.lit(""))
    df = raw.withColumn("_t", text)
    t = F.col("_t")
    df = df.withColumns(
        {
            "mentioned_themes": theme_tags(t, patterns),
            "mentioned_keywords": theme_keywords(t, patterns),
            "mentioned_stocks": F.transform(stock_codes(t), lambda c: F.struct(c.alias("code"), F.lit(None).cast("string").alias("name"))),
            "_hard": keyword_hits(t, words["hard"]), "_emotion": keyword_hits(t, words["emotion"]), "_risk": keyword_hits(t, words["risk"]),
            "content_available": (F.col("fetch_status") == "success") & (F.trim(t) != ""),
        }
    )
    themed, hard_hits, ok = F.size("mentioned_themes") > 0, F.size("_hard") > 0, F.col("content_available")
    df = df.withColumns(
        {
            "hard_logic_score": F.least(F.lit(100), 15 * F.size("_hard") + 10 * F.size("mentioned_themes")),
            "emotion_score": F.least(F.lit(100), 18 * F.size("_emotion")),
        }
    )
    value = F.when((F.col("hard_logic_score") >= 50) & themed, "usable_signal").when(themed, "watch_only").otherwise("sentiment_only")
    kind = F.when(F.size("_risk") > 0, "risk").when(themed | hard_hits, "opinion").otherwise("sentiment")
    crowd = F.when(F.col("emotion_score") >= 55, "high").when(F.col("emotion_score") >= 25, "medium").otherwise("low")
    missing = F.concat(F.lit("Content not fetched: "), F.coalesce("error", F.lit("None")))
    df = df.withColumns(
        {
            "signal_type": F.when(ok, kind).otherwise("unknown"), "crowding_risk": F.when(ok, crowd).otherwise("unknown"),
            "freshness": F.lit("unknown"), "trade_value": F.when(ok, value).otherwise("pending_fetch"),
            "core_view": F.when(ok, one_line(t, 240)).otherwise(missing),
            "evidence": F.array_sort(F.array_distinct(F.concat("_hard", "_risk"))),
            "risk_notes": F.when(F.size("_risk") > 0, F.col("_risk")).when(ok, F.array().cast("array<string>")).otherwise(F.array("error")),
        }
    )
    usable = ok & F.col("trade_value").isin("usable_signal", "watch_only")
    return df.withColumn("usable_for_trading", usable).drop("_t", "_hard", "_emotion", "_risk")


def fetch_status_counts(raw: DataFrame) -> DataFrame:
    """How many texts each source delivered, by fetch status; a missing status is ``unknown``."""
    return raw.groupBy("source_name", F.coalesce("fetch_status", F.lit("unknown")).alias("fetch_status")).agg(F.count(F.lit(1)).alias("n"))
