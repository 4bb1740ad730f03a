"""News: normalization, enrichment, dedup-merge, filters, paging and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions import constants, times
from tapeline.functions.codes import zero_padded
from tapeline.functions.hashing import dedup_key, item_id
from tapeline.functions.numbers import first_text
from tapeline.functions.text import any_keyword, combined_text, keyword_hits, ordered_union, repair_mojibake
from tapeline.functions.times import bind
from tapeline.operators.scaling import latest_by

SEARCH_FIELDS = ("title", "content", "summary", "stock_name", "stock_code")
LIST_COLUMNS = (
    "id", "source", "title", "publish_time", "publish_time_bj", "source_time", "crawled_at", "collected_at", "stock_code",
    "stock_name", "announcement_type", "url", "source_urls",
)


def _col(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def drop_analysis(df: DataFrame) -> DataFrame:
    """Source facts only."""
    return df.drop(*[c for c in constants.ANALYSIS_COLUMNS if c in df.columns])


def normalize_news(items: DataFrame, now: Column | None = None) -> DataFrame:
    """Beijing times, notes, latency and provenance columns; analysis columns are dropped."""
    df = drop_analysis(items)
    df = df.withColumns({"_p": times.publish_time("publish_time", "source"), "_c": times.crawl_time(_col(df, "crawled_at"), now)})
    p, c = F.col("_p.ts"), F.col("_c.ts")
    iso_p = F.coalesce(times.iso_text(p), F.lit(""))
    df = df.withColumns(
        {
            "stock_code": zero_padded(F.coalesce(_col(df, "stock_code"), F.lit(""))),
            "publish_time_bj": iso_p,
            "publish_time_bj_display": F.coalesce(times.ntz_text(p), F.lit("")),
            "publish_date_bj": F.coalesce(F.substring(p.cast("string"), 1, 10), F.lit("")),
            "time_normalized": p.isNotNull(),
            "time_parse_note": F.col("_p.note"),
            "crawled_at": times.iso_text(c),
            "collected_at": times.iso_text(c),
            "crawled_at_display": times.ntz_text(c),
            "crawled_date_bj": F.substring(c.cast("string"), 1, 10),
            "crawl_time_note": F.col("_c.note"),
            "crawled_at_source": F.coalesce(_col(df, "crawled_at_source"), F.lit("runtime")),
            "latency_minutes": F.round(times.latency_minutes(c, p), 2),
            "latency_note": F.when(p.isNotNull(), F.lit("crawled_at_minus_publish_time")).otherwise(F.lit("missing_or_unparsed_publish_time")),
            "source_time": first_text(iso_p, F.coalesce(F.col("publish_time"), F.lit(""))),
            "source_urls": ordered_union(_col(df, "source_urls", "array<string>"), F.array(F.trim(F.coalesce(_col(df, "url"), F.lit(""))))),
        }
    )
    return df.drop("_p", "_c")


def with_latency_level(df: DataFrame) -> DataFrame:
    return df.withColumn("latency_level", times.latency_level("latency_minutes"))


def _hits(low: Column, words: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.when(low.contains(w.lower()), F.lit(w)) for w in words]))


def enrich_news(
    items: DataFrame, risk: Mapping[str, Sequence[str]] = constants.RISK_KEYWORDS, impact=constants.IMPACT_GROUPS,
    base: Mapping[str, int] = constants.SOURCE_BASE_SCORE, high: Sequence[str] = constants.HIGH_RISK_FLAGS,
    medium: Sequence[str] = constants.MEDIUM_RISK_FLAGS,
) -> DataFrame:
    """Risk flags, impact score, tier and reasons.

    The lower-cased search text is built and searched once per row; dictionaries are literals in the plan.
    """
    groups = sorted(impact, key=lambda g: -g[1])
    flags = list(risk)

    def search(x: Column) -> Column:
        cells = [_hits(x["low"], risk[f]).alias(f"r{i}") for i, f in enumerate(flags)]
        cells += [_hits(x["low"], words).alias(f"g{i}") for i, (_, _, words) in enumerate(groups)]
        start = F.lit(constants.DEFAULT_BASE_SCORE)
        for source, value in base.items():
            start = F.when(x["source"] == source, F.lit(value)).otherwise(start)
        return F.struct(*cells, start.alias("base"))

    def risks(h: Column) -> Column:
        found = lambda f: F.size(h[f"r{flags.index(f)}"]) > 0
        some = lambda names: reduce(lambda a, b: a | b, [found(f) for f in flags if f in names], F.lit(False))
        level = F.when(some(high), "high").when(some(medium), "medium").when(some(flags), "low").otherwise("none")
        why = [F.when(found(f), F.concat(F.lit(f + ": "), F.array_join(F.slice(h[f"r{i}"], 1, 3), ", "))) for i, f in enumerate(flags)]
        return F.struct(
            h.alias("h"), level.alias("level"), F.array_compact(F.array(*[F.when(found(f), F.lit(f)) for f in flags])).alias("flags"),
            F.array_compact(F.array(*why)).alias("reasons"),
        )

    def assess(r: Column) -> Column:
        h, level = r["h"], r["level"]
        found = lambda i: F.size(h[f"g{i}"]) > 0
        rank, total = F.lit(0), h["base"]
        reasons = [F.concat(F.lit("source_base:"), h["base"].cast("string"))]
        tier = F.lit("general")
        for i, (name, weight, _) in enumerate(groups):
            # Python rounding of the constants: halves go to the even neighbour.
            applied = F.when(rank == 0, F.lit(weight)).when(rank == 1, F.lit(round(weight * 0.6))).otherwise(F.lit(min(8, round(weight * 0.3))))
            total = total + F.when(found(i), applied).otherwise(F.lit(0))
            quoted = F.array_join(F.slice(h[f"g{i}"], 1, 4), ", ")
            reasons.append(F.when(found(i), F.concat(F.lit(f"{name}+"), applied.cast("string"), F.lit(": "), quoted)))
            rank = rank + found(i).cast("int")
        for i, (name, _, _) in reversed(list(enumerate(groups))):
            tier = F.when(found(i), F.lit(name)).otherwise(tier)
        alert = level.isin("medium", "high")
        floor = F.when(level == "high", F.lit(75)).when(level == "medium", F.lit(65)).otherwise(F.lit(0))
        reasons.append(F.when(alert, F.concat(F.lit("risk_alert_floor:"), floor.cast("string"))))
        score = F.least(F.greatest(total, floor), F.lit(100))
        return F.struct(
            r["flags"].alias("risk_flags"), r["reasons"].alias("risk_reasons"), level.alias("risk_level"), alert.alias("is_risk_alert"),
            score.alias("news_score"), F.when(alert, F.lit("risk_alert")).otherwise(tier).alias("news_tier"),
            F.array_compact(F.array(*reasons)).alias("impact_reasons"), ((score >= 65) | alert).alias("is_high_impact"),
        )

    text = combined_text(*[_col(items, c) for c in SEARCH_FIELDS])
    given = F.struct(F.lower(text).alias("low"), F.lower("source").alias("source"))
    df = items.withColumn("_e", bind(bind(bind(given, search), risks), assess))
    return df.select(*[c for c in items.columns], "_e.*")


#: The key of an announcement without code, title and time.
NO_KEY = "||"


def item_key(items: DataFrame) -> Column:
    """The key that copies of an item share. A row without any gets its address as part of the key."""
    return F.when(dedup_key() == NO_KEY, F.concat(F.lit(NO_KEY), F.coalesce(_col(items, "url"), F.lit("")))).otherwise(dedup_key())


def item_urls(items: DataFrame) -> Column:
    return ordered_union(_col(items, "source_urls", "array<string>"), F.array(_col(items, "url")))


def collection_time(items: DataFrame) -> Column:
    return F.nullif(F.coalesce(_col(items, "collected_at"), _col(items, "crawled_at")), F.lit(""))


def merge_duplicates(items: DataFrame, arrival: str, by: Sequence[str] = ("source", "publish_date_bj")) -> DataFrame:
    """One row per store key: the first arrival's fields, all URLs in order of arrival, the earliest collection time.

    URLs are reduced to one row per (key, url) before they are gathered, so a flood of copies of one item only
    costs as much as its distinct URLs. An announcement without code, title and time says nothing of what it is a copy of:
    its address is part of its key, so such rows merge by address and no list of theirs grows.
    """
    by = list(by)
    keyed = items.withColumn("item_key", item_key(items))
    group = [*by, "item_key"]
    rest = [c for c in items.columns if c not in (*by, "source_urls", "collected_at", "crawled_at")]
    first = keyed.groupBy(*group).agg(
        F.min_by(F.struct(*rest), F.col(arrival)).alias("_r"), F.min(collection_time(items)).alias("collected_at"), F.count(F.lit(1)).alias("n_copies")
    )
    each = keyed.select(*group, arrival, F.posexplode(item_urls(items)).alias("_pos", "_url"))
    once = each.groupBy(*group, "_url").agg(F.min(F.struct(arrival, "_pos")).alias("_at"))
    lists = once.groupBy(*group).agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_url"))), lambda x: x["_url"]).alias("source_urls"))
    out = first.join(lists, group, "left")
    return out.select(
        *by, "item_key", *[F.col("_r")[c].alias(c) for c in rest], "collected_at", F.col("collected_at").alias("crawled_at"),
        F.coalesce("source_urls", F.array().cast("array<string>")).alias("source_urls"), "n_copies",
    )


def cross_source_merge(items: DataFrame, key: str = "url", time: str = "publish_time_bj") -> DataFrame:
    """The same story from several sources: earliest publish time, all confirming sources."""
    return items.where(F.coalesce(key, F.lit("")) != "").groupBy(key).agg(
        F.min(time).alias(time), F.array_sort(F.collect_set("source")).alias("sources"), F.count(F.lit(1)).alias("n_items")
    )


def distinct_items(items: DataFrame, order: str) -> DataFrame:
    """First seen per (source, title, url); titles must be filled."""
    titled = items.withColumn("title", F.trim("title")).where(F.col("title") != "")
    return latest_by(titled, ["source", "title", "url"], order, newest=False)


def unseen(batch: DataFrame, seen_hashes: DataFrame) -> DataFrame:
    """Rows whose source-wide hash is not in the index (column ``item_hash``)."""
    from tapeline.functions.hashing import dedup_hash

    return batch.withColumn("item_hash", dedup_hash()).join(seen_hashes.select("item_hash").distinct(), "item_hash", "left_anti")


# --- filters --------------------------------------------------------------------------------------------


def filter_news(
    items: DataFrame, source: str = "all", keyword: str = "", stock_code: str = "", date_from: str = "", date_to: str = "",
    today: str = "", retention_days: int = 0, date: str = "publish_date_bj",
) -> DataFrame:
    """News query; source and date conditions fall on the partition columns of the store."""
    out = items
    if source != "all":
        out = out.where(F.col("source") == source)
    if date_from:
        out = out.where(F.col(date) >= date_from)
    if date_to:
        out = out.where(F.col(date) <= date_to)
    if not date_from and not date_to and retention_days > 0 and today:
        out = out.where(F.col(date) >= F.date_sub(F.lit(today).cast("date"), retention_days).cast("string"))
    if keyword:
        blank = lambda c: F.coalesce(_col(items, c), F.lit(""))
        out = out.where(F.concat_ws(" ", blank("title"), blank("content"), blank("summary")).contains(keyword))
    if stock_code:
        out = out.where(F.col("stock_code") == stock_code)
    return out


def collected_after(items: DataFrame, moment: Column) -> DataFrame:
    """Strictly newer than a wall-clock time; the crawl time stands in for a missing collection time."""
    text = F.coalesce(F.nullif(_col(items, "collected_at"), F.lit("")), _col(items, "crawled_at"))
    return items.where(times.iso_to_beijing(text) > moment)


def search_titles(items: DataFrame, keyword: str = "", source: str = "", stock_code: str = "") -> DataFrame:
    out = items
    if source:
        out = out.where(F.col("source") == source)
    if stock_code:
        out = out.where(F.col("stock_code") == stock_code)
    return out.where(F.lower("title").contains(keyword.lower())) if keyword else out


def keyword_filter(items: DataFrame, keywords: Sequence[str], fields: Sequence[str] = ("title", "content")) -> DataFrame:
    """Any keyword in any text field; fields that are absent or not text are skipped."""
    kinds = dict(items.dtypes)
    cond = F.lit(False)
    for f in fields:
        if kinds.get(f) == "string":
            cond = cond | any_keyword(F.col(f), keywords)
    return items.where(cond)


def annotate_keywords(items: DataFrame, keywords: Sequence[str], hard_filter: bool = False) -> DataFrame:
    """``matched_keywords`` in alphabetical order; optionally only rows that have some."""
    text = F.concat_ws(" ", F.coalesce(_col(items, "title"), F.lit("")), F.coalesce(_col(items, "content"), F.lit("")))
    out = items.withColumn("matched_keywords", keyword_hits(text, sorted(keywords)))
    return out.where(F.size("matched_keywords") > 0) if hard_filter else out


def with_item_id(items: DataFrame) -> DataFrame:
    """Published form: repaired text and the item id."""
    fixed = items.withColumns({c: repair_mojibake(c) for c in ("title", "content", "summary") if c in items.columns})
    return fixed.withColumn("id", item_id())


def item_time(items: DataFrame) -> Column:
    """Sort time of an item: text without a zone is taken as it is; unparsable counts as oldest."""
    return times.iso_to_beijing(F.coalesce(F.nullif(_col(items, "publish_time_bj"), F.lit("")), F.col("publish_time")))


def newest_first(items: DataFrame) -> list[Column]:
    return [item_time(items).desc_nulls_last(), F.col("id").asc()]


def page(items: DataFrame, order: Sequence[Column], offset: int = 0, limit: int = 200) -> DataFrame:
    """One page of a total order with the page facts as columns. Spark keeps only ``offset + limit`` rows per task."""
    total = items.groupBy().count().scalar()
    rows = items.orderBy(*order).offset(offset).limit(limit)
    return rows.withColumns(
        {
            "expected_count": total,
            "next_offset": F.when(F.lit(offset + limit) < total, F.lit(offset + limit)),
            "is_complete": F.lit(offset + limit) >= total,
        }
    )


def page_after(items: DataFrame, order: Sequence[tuple[str, bool]], last: Sequence, limit: int = 200) -> DataFrame:
    """The page after a known row, for deep paging: the row's key becomes a filter, so earlier rows are never sorted.

    ``order`` lists (column, descending) and ends in a unique column; ``last`` holds that row's values, each possibly null. Nulls
    are last in every column.
    """
    cond, equal = F.lit(False), F.lit(True)
    for (c, desc), v in zip(order, last):
        if v is not None:  # nothing follows a null but what the next columns decide
            beyond = F.coalesce((F.col(c) < v) if desc else (F.col(c) > v), F.lit(True))
            cond = cond | (equal & beyond)
        equal = equal & F.col(c).eqNullSafe(F.lit(v))
    return items.where(cond).orderBy(*[F.desc_nulls_last(c) if desc else F.asc_nulls_last(c) for c, desc in order]).limit(limit)


def list_columns(items: DataFrame) -> DataFrame:
    return items.select(*[c for c in LIST_COLUMNS if c in items.columns])


# --- reports --------------------------------------------------------------------------------------------


def theme_matches(items: DataFrame, themes: Mapping[str, Sequence[str]] = constants.NEWS_THEMES) -> DataFrame:
    """One row per item and theme it touches."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(_col(items, c), F.lit("")) for c in ("title", "content", "stock_name", "stock_code")]))
    df = items.withColumn("_text", text)
    hit = lambda words: any_keyword(F.col("_text"), [w.lower() for w in words])
    tags = F.filter(F.array(*[F.when(hit(words), F.lit(theme)) for theme, words in themes.items()]), lambda x: x.isNotNull())
    return df.withColumn("theme", F.explode(tags)).drop("_text")


def theme_heat(items: DataFrame, themes: Mapping[str, Sequence[str]] = constants.NEWS_THEMES, time: str = "publish_time_bj", tie: str = "id") -> DataFrame:
    return theme_matches(items, themes).groupBy("theme").agg(
        F.count(F.lit(1)).alias("n_items"), F.max_by("title", F.struct(time, tie)).alias("latest_title")
    )


def high_impact(items: DataFrame, words: Sequence[str] = constants.HIGH_IMPACT_WORDS) -> DataFrame:
    text = F.concat_ws(" ", *[F.coalesce(_col(items, c), F.lit("")) for c in ("title", "content", "stock_name", "stock_code")])
    return items.where(F.col("is_high_impact") | (F.col("news_score") >= 65) | any_keyword(text, words, ignore_case=True))


def impact_list(items: DataFrame, limit: int = 50, words: Sequence[str] = constants.HIGH_IMPACT_WORDS, time: str = "publish_time_bj") -> DataFrame:
    return high_impact(items, words).orderBy(F.desc("news_score"), F.desc_nulls_last(time), F.asc("id")).limit(limit)


def risk_list(items: DataFrame, limit: int = 50, time: str = "publish_time_bj") -> DataFrame:
    alerts = items.where(F.col("is_risk_alert") | (F.size("risk_flags") > 0))
    return alerts.orderBy(F.desc(F.col("risk_level") == "high"), F.desc("news_score"), F.desc_nulls_last(time), F.asc("id")).limit(limit)


def changed_rows(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys whose listed columns differ (null-safe) between two versions."""
    old = before.select(key, F.struct(*columns).alias("_old"))
    new = after.select(key, F.struct(*columns).alias("_new"))
    return new.join(old, key, "left").where(~F.col("_new").eqNullSafe(F.col("_old"))).select(key)
