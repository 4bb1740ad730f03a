"""News queries. Dictionaries use frequent letter groups of the driver's own languages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.functions import hashing, text, times
from tapeline.operators import keywords as W
from tapeline.operators import news as N
from tapeline.queries import ctes as C
from tapeline.queries.registry import query
from tapeline.sources import driver_tables as D

RISK = {
    "share_reduction": ("eshed", "auschen"), "clarification": ("ndston", "ciónca"), "performance": ("hathe ",), "legal": ("Thisth", "ichger"),
    "minor": ("oneser",),
}
IMPACT = (
    ("policy", 35, ("ingthe", "euxle", "gerch")), ("market_confirmation", 30, ("Andre", "undsch", "ciónes")), ("industry_catalyst", 25, ("thatin", "queles")),
    ("global_macro", 20, ("withth", "paraci")), ("company_event", 15, ("forth", "dieich", "ousre")),
)
PLATES = {"north": ("the", "and", "ing"), "west": ("que", "and", "les"), "east": ("der", "die", "sch"), "south": ("cion", "ción", "los")}
THEMES = {"alpha": ("EATI", "schun"), "beta": ("ouela", "andth"), "gamma": ("ciórr",)}


def raw(spark, sf):
    return D.news(spark, sf)


def normalized(spark, sf):
    return N.normalize_news(raw(spark, sf))


NOTE = """CASE doc_id % 5 WHEN 0 THEN CASE WHEN source = 'cls' THEN 'cls_z_as_utc' WHEN source = 'cninfo' AND bj::time = time '00:00:00' AND publish_time LIKE '%16:00:00Z'
 THEN 'cninfo{mid}_z_as_utc' ELSE source || '_z_as_beijing_local' END WHEN 3 THEN 'timezone_converted_to_beijing' ELSE 'naive_as_beijing' END"""
ISO = "strftime({t}, '%Y-%m-%dT%H:%M:%S') || '+08:00'"
NORMAL = f"""norm AS (SELECT doc_id, source, lang, title, content, summary, url, publish_time, stock_name, announcement_type,
 CASE WHEN stock_code = '' THEN '' ELSE lpad(stock_code, 6, '0') END AS stock_code, {ISO.format(t='bj')} AS publish_time_bj,
 strftime(bj, '%Y-%m-%d %H:%M:%S') AS publish_time_bj_display, strftime(bj, '%Y-%m-%d') AS publish_date_bj, true AS time_normalized,
 {NOTE.format(mid='')} AS time_parse_note, {ISO.format(t='collected')} AS crawled_at, {ISO.format(t='collected')} AS collected_at,
 strftime(collected, '%Y-%m-%d %H:%M:%S') AS crawled_at_display, strftime(collected, '%Y-%m-%d') AS crawled_date_bj,
 'timezone_converted_to_beijing' AS crawl_time_note, round((epoch_us(collected) - epoch_us(bj)) / 60000000.0, 2) AS latency_minutes,
 'crawled_at_minus_publish_time' AS latency_note, {ISO.format(t='bj')} AS source_time, bj, collected FROM news)"""
LEVEL = "CASE WHEN latency_minutes < -1 THEN 'clock_skew' WHEN latency_minutes <= 10 THEN 'fast' WHEN latency_minutes <= 60 THEN 'normal' WHEN latency_minutes <= 180 THEN 'slow' ELSE 'stale' END"
NORM_COLUMNS = (
    "doc_id source title stock_code publish_time_bj publish_time_bj_display publish_date_bj time_normalized time_parse_note crawled_at collected_at "
    "crawled_at_display crawled_date_bj crawl_time_note latency_minutes latency_note source_time"
).split()


@query("c09_normalized_news", C.with_ctes(C.NEWS, NORMAL, select=f"SELECT {', '.join(NORM_COLUMNS)}, url AS first_url FROM norm"))
def c09(spark, sf):
    return normalized(spark, sf).select(*NORM_COLUMNS, F.element_at("source_urls", 1).alias("first_url"))


@query("x06_publish_times", C.with_ctes(C.NEWS, select=f"SELECT doc_id, strftime(bj, '%Y-%m-%d %H:%M:%S') AS bj, {NOTE.format(mid='_midnight')} AS note FROM news"))
def x06(spark, sf):
    p = times.publish_time("publish_time", "source", enricher_notes=True)
    return raw(spark, sf).withColumn("p", p).select("doc_id", times.ntz_text("p.ts").alias("bj"), "p.note")


@query("x07_crawl_times", C.with_ctes(C.NEWS, select="SELECT doc_id, strftime(collected, '%Y-%m-%d %H:%M:%S') AS at, 'timezone_converted_to_beijing' AS note FROM news"))
def x07(spark, sf):
    return raw(spark, sf).withColumn("c", times.crawl_time("crawled_at", enricher_notes=True)).select("doc_id", times.ntz_text("c.ts").alias("at"), "c.note")


@query("x08_latency_levels", C.with_ctes(C.NEWS, NORMAL, select=f"SELECT doc_id, latency_minutes, {LEVEL} AS latency_level FROM norm"))
def x08(spark, sf):
    return N.with_latency_level(normalized(spark, sf)).select("doc_id", "latency_minutes", "latency_level")


@query("x09_mojibake_repair", "SELECT doc_id, text AS repaired FROM documents")
def x09(spark, sf):
    """Texts with ä, ã or Â are garbled on purpose; every text must come back."""
    d = D.table(spark, sf, "documents")
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    looks = garbled.rlike("[äãÂ]") & ~F.col("text").rlike("[^\u0000-ÿ]")
    return d.select("doc_id", text.repair_mojibake(F.when(looks, garbled).otherwise(F.col("text"))).alias("repaired"))


@query("x10_item_ids", C.with_ctes(C.NEWS, select="SELECT doc_id, substr(sha256(source || '|' || stock_code || '|' || title || '|' || publish_time || '|' || url), 1, 24) AS id FROM news"))
def x10(spark, sf):
    return raw(spark, sf).select("doc_id", hashing.item_id().alias("id"))


KEY = "CASE WHEN source = 'cninfo' THEN stock_code || '|' || title || '|' || publish_time ELSE url END"


@query("x12_dedup_keys", C.with_ctes(C.NEWS, select=f"SELECT doc_id, sha256({KEY}) AS item_hash FROM news"))
def x12(spark, sf):
    return raw(spark, sf).select("doc_id", hashing.dedup_hash().alias("item_hash"))


@query("x13_keyword_hits", "SELECT doc_id, array_to_string(list_filter(['and','Que','der','the ','los'], lambda k: contains(lower(text), lower(k))), '|') AS any_case, array_to_string(list_filter(['and','Que','der','the ','los'], lambda k: contains(text, k)), '|') AS exact FROM documents")
def x13(spark, sf):
    words = ("and", "Que", "der", "the ", "los")
    t = F.col("text")
    return D.table(spark, sf, "documents").select(
        "doc_id", F.array_join(text.keyword_hits(t, words, True), "|").alias("any_case"), F.array_join(text.keyword_hits(t, words), "|").alias("exact")
    )


@query("x14_occurrence_counts", "SELECT doc_id, ((length(text) - length(replace(text, 'the', ''))) / 3)::int AS n_the, ((length(text) - length(replace(text, 'aa', ''))) / 2)::int AS n_aa FROM documents")
def x14(spark, sf):
    return D.table(spark, sf, "documents").select("doc_id", text.occurrences(F.col("text"), "the").alias("n_the"), text.occurrences(F.col("text"), "aa").alias("n_aa"))


@query("x19_time_formats", C.with_ctes(C.NEWS, select="""
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN publish_time WHEN 3 THEN publish_time ELSE replace(replace(rpad(publish_time, 19, ':00'), ' ', 'T'), '/', '-') || 'Z' END AS normalized FROM news"""))
def x19(spark, sf):
    return raw(spark, sf).select("doc_id", times.many_formats("publish_time").alias("normalized"))


@query("x20_absolute_urls", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN 'http://host/' || page_id::varchar ELSE 'http://host/p' || page_id::varchar END AS url FROM pages")
def x20(spark, sf):
    i = F.col("page_id")
    rel = F.when(i % 3 == 0, F.col("url")).when(i % 3 == 1, F.concat(F.lit("/"), i.cast("string"))).otherwise(F.concat(F.lit("p"), i.cast("string")))
    return D.table(spark, sf, "pages").select("page_id", text.absolute_url(rel, "http://host").alias("url"))


@query("x21_list_fields", "SELECT doc_id, array_to_string(list_filter(list_transform(string_split(replace(head, ';', ','), ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS parts FROM (SELECT doc_id, lang || ', ' || source || ';' || n_chars::varchar || ',' AS head FROM documents)")
def x21(spark, sf):
    head = F.concat("lang", F.lit(", "), "source", F.lit(";"), F.col("n_chars").cast("string"), F.lit(","))
    return D.table(spark, sf, "documents").select("doc_id", F.array_join(text.split_list(head, ",;"), "|").alias("parts"))


@query("x22_json_paths", "SELECT event_id, coalesce(props->>'$.k', '-1') AS k, 'none' AS missing FROM events")
def x22(spark, sf):
    return D.table(spark, sf, "events").select("event_id", text.json_path("props", "k", "-1").alias("k"), text.json_path("props", "k.0.x", "none").alias("missing"))


@query("x31_item_dates", C.with_ctes(C.NEWS, select="""
SELECT doc_id, CASE WHEN doc_id % 5 = 2 THEN strftime(collected, '%Y-%m-%d') ELSE substr(publish_time, 1, 10) END AS item_date,
 strftime(collected, '%Y-%m-%d %H:%M:%S') AS collected FROM news"""))
def x31(spark, sf):
    r = raw(spark, sf)
    return r.select(
        "doc_id", times.item_date(F.lit(None).cast("string"), "publish_time", "crawled_at").alias("item_date"),
        times.ntz_text(times.item_collected_at(F.lit(""), "crawled_at", "publish_time")).alias("collected"),
    )


@query("x36_other_time_rules", C.with_ctes(C.NEWS, select="""
SELECT doc_id, CASE doc_id % 5 WHEN 2 THEN NULL WHEN 0 THEN strftime(wall2 + interval 8 hour, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(wall2 + interval 8 hour, '%Y-%m-%d %H:%M:%S')
 ELSE strftime(wall2, '%Y-%m-%d %H:%M:%S') END AS naive_beijing,
 CASE doc_id % 5 WHEN 2 THEN NULL ELSE strftime(wall2 + interval 8 hour, '%Y-%m-%d %H:%M:%S') END AS naive_utc
FROM (SELECT *, timestamp '2024-01-01' + to_minutes(37 * doc_id) AS wall2 FROM news)"""))
def x36(spark, sf):
    return raw(spark, sf).select(
        "doc_id", times.ntz_text(times.iso_to_beijing("publish_time")).alias("naive_beijing"),
        times.ntz_text(times.iso_to_beijing("publish_time", naive_zone="utc")).alias("naive_utc"),
    )


@query("x37_search_text", C.with_ctes(C.NEWS, select="SELECT doc_id, md5(concat_ws(' ', nullif(title, ''), nullif(content, ''), nullif(summary, ''), nullif(stock_name, ''), nullif(stock_code, ''))) AS text_md5 FROM news"))
def x37(spark, sf):
    return raw(spark, sf).select("doc_id", F.md5(text.combined_text(*N.SEARCH_FIELDS)).alias("text_md5"))


def _hits(words, col="lower(txt)"):
    return "list_filter([" + ",".join(f"'{w}'" for w in words) + f"], lambda k: contains({col}, lower(k)))"


ENRICH = "e0 AS (SELECT *, concat_ws(' ', nullif(title, ''), nullif(content, ''), nullif(summary, ''), nullif(stock_name, ''), nullif(stock_code, '')) AS txt FROM norm), e1 AS (SELECT *, " + ", ".join(
    f"{_hits(w)} AS r_{f}" for f, w in RISK.items()
) + ", " + ", ".join(f"{_hits(w)} AS g{i}" for i, (_, _, w) in enumerate(IMPACT)) + " FROM e0), e2 AS (SELECT *, array_to_string(list_filter([" + ",".join(
    f"CASE WHEN len(r_{f}) > 0 THEN '{f}' END" for f in RISK
) + "], lambda x: x IS NOT NULL), ',') AS risk_flags, array_to_string(list_filter([" + ",".join(
    f"CASE WHEN len(r_{f}) > 0 THEN '{f}: ' || array_to_string(r_{f}[1:3], ', ') END" for f in RISK
) + "], lambda x: x IS NOT NULL), ';') AS risk_reasons, CASE WHEN len(r_share_reduction) > 0 THEN 'high' WHEN len(r_clarification) + len(r_performance) + len(r_legal) > 0 THEN 'medium' WHEN len(r_minor) > 0 THEN 'low' ELSE 'none' END AS risk_level, " + ", ".join(
    (" + ".join(f"(len(g{j}) > 0)::int" for j in range(i)) or "0") + f" AS p{i}" for i in range(5)
) + ", CASE source WHEN 'ndrc' THEN 35 WHEN 'cls' THEN 25 WHEN 'eastmoney_global' THEN 22 ELSE 18 END AS base FROM e1), e3 AS (SELECT *, least(100, greatest(base + " + " + ".join(
    f"CASE WHEN len(g{i}) = 0 THEN 0 WHEN p{i} = 0 THEN {w} WHEN p{i} = 1 THEN {round(w * .6)} ELSE {min(8, round(w * .3))} END" for i, (_, w, _) in enumerate(IMPACT)
) + ", CASE risk_level WHEN 'high' THEN 75 WHEN 'medium' THEN 65 ELSE 0 END))::int AS news_score, CASE WHEN risk_level IN ('medium', 'high') THEN 'risk_alert' " + " ".join(
    f"WHEN len(g{i}) > 0 THEN '{n}'" for i, (n, _, _) in enumerate(IMPACT)
) + " ELSE 'general' END AS news_tier FROM e2), enr AS (SELECT *, news_score >= 65 OR risk_level IN ('medium', 'high') AS is_high_impact, risk_level IN ('medium', 'high') AS is_risk_alert, substr(sha256(source || '|' || stock_code || '|' || title || '|' || publish_time || '|' || url), 1, 24) AS id FROM e3)"


def enriched(spark, sf):
    return N.enrich_news(N.normalize_news(raw(spark, sf)), RISK, IMPACT)


@query("c08_enriched_news", C.with_ctes(C.NEWS, NORMAL, ENRICH, select="SELECT doc_id, risk_flags, risk_reasons, risk_level, is_risk_alert, news_score, news_tier, is_high_impact FROM enr"))
def c08(spark, sf):
    return enriched(spark, sf).select(
        "doc_id", F.array_join("risk_flags", ",").alias("risk_flags"), F.array_join("risk_reasons", ";").alias("risk_reasons"), "risk_level",
        "is_risk_alert", "news_score", "news_tier", "is_high_impact",
    )


@query("c24_enrichment_backfill", C.with_ctes(C.NEWS, NORMAL, ENRICH, select="SELECT doc_id FROM enr WHERE news_tier <> 'general' OR risk_level <> 'none'"))
def c24(spark, sf):
    after = enriched(spark, sf)
    before = after.withColumns({"news_tier": F.lit("general"), "risk_level": F.lit("none")})
    return N.changed_rows(before, after, "doc_id", ["news_tier", "risk_level"])


@query("k05_impact_and_risk_lists", C.with_ctes(C.NEWS, NORMAL, ENRICH, select="""
SELECT * FROM (SELECT 'impact' AS list, doc_id, news_score FROM enr WHERE is_high_impact OR contains(lower(title || ' ' || content || ' ' || stock_name || ' ' || stock_code), 'theher')
 ORDER BY news_score DESC, publish_time_bj DESC, id LIMIT 50)
UNION ALL SELECT * FROM (SELECT 'risk', doc_id, news_score FROM enr WHERE risk_level <> 'none' ORDER BY risk_level = 'high' DESC, news_score DESC, publish_time_bj DESC, id LIMIT 50)"""))
def k05(spark, sf):
    e = enriched(spark, sf).withColumn("id", hashing.item_id())
    one = N.impact_list(e, words=("Theher",)).select(F.lit("impact").alias("list"), "doc_id", "news_score")
    return one.unionByName(N.risk_list(e).select(F.lit("risk").alias("list"), "doc_id", "news_score"))


MERGED = f"""m0 AS (SELECT *, {KEY} AS item_key FROM norm),
merged AS (SELECT source, publish_date_bj, item_key, arg_min(doc_id, doc_id) AS doc_id, arg_min(title, doc_id) AS title, min(collected_at) AS collected_at, count(*) AS n_copies,
 array_to_string(list_sort(list_distinct(list(url))), ',') AS urls FROM m0 GROUP BY 1, 2, 3)"""


@query("c10_dedup_merge", C.with_ctes(C.NEWS, NORMAL, MERGED, select="SELECT source, publish_date_bj, item_key, doc_id, title, collected_at, n_copies, urls FROM merged"))
def c10(spark, sf):
    m = N.merge_duplicates(normalized(spark, sf), "doc_id")
    return m.select("source", "publish_date_bj", "item_key", "doc_id", "title", "collected_at", "n_copies", F.array_join(F.array_sort("source_urls"), ",").alias("urls"))


@query("c10_cross_source_merge", C.with_ctes(C.NEWS, NORMAL, select="SELECT url, min(publish_time_bj) AS publish_time_bj, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS n_items FROM norm GROUP BY 1"))
def c10_cross(spark, sf):
    return N.cross_source_merge(normalized(spark, sf)).withColumn("sources", F.array_join("sources", ","))


@query("u05_url_union", C.with_ctes(C.NEWS, NORMAL, MERGED, select="SELECT source, publish_date_bj, item_key, urls FROM merged"))
def u05(spark, sf):
    m = N.merge_duplicates(normalized(spark, sf), "doc_id")
    return m.select("source", "publish_date_bj", "item_key", F.array_join(F.array_sort("source_urls"), ",").alias("urls"))


@query("u06_distinct_items", C.with_ctes(C.NEWS, select="SELECT source, trim(title) AS title, url, min(doc_id) AS doc_id FROM news WHERE trim(title) <> '' GROUP BY 1, 2, 3"))
def u06(spark, sf):
    return N.distinct_items(raw(spark, sf), "doc_id").select("source", "title", "url", "doc_id")


@query("p04_news_predicate", C.with_ctes(C.NEWS, NORMAL, select="""
SELECT doc_id FROM norm WHERE source = 'cls' AND contains(title || ' ' || content || ' ' || summary, 'tion') AND publish_date_bj BETWEEN '2024-01-03' AND '2024-01-20'"""))
def p04(spark, sf):
    return N.filter_news(normalized(spark, sf), "cls", "tion", date_from="2024-01-03", date_to="2024-01-20").select("doc_id")


@query("p05_collected_after", C.with_ctes(C.NEWS, select="SELECT doc_id FROM news WHERE collected > timestamp '2024-01-10 08:30:00'"))
def p05(spark, sf):
    return N.collected_after(raw(spark, sf), F.lit("2024-01-10 08:30:00").cast("timestamp_ntz")).select("doc_id")


@query("p06_title_search", C.with_ctes(C.NEWS, NORMAL, select="SELECT doc_id, count(*) OVER () AS total FROM norm WHERE contains(lower(title), 'supplier') AND source = 'ndrc'"))
def p06(spark, sf):
    m = N.search_titles(normalized(spark, sf), "SUPPLIER", "ndrc").select("doc_id")
    return m.withColumn("total", m.groupBy().count().scalar())


@query("p08_keyword_filter", "SELECT doc_id FROM documents WHERE contains(text, 'ngth') OR contains(text, 'gerich')")
def p08(spark, sf):
    return N.keyword_filter(D.table(spark, sf, "documents"), ("ngth", "gerich"), ("text", "n_chars", "absent")).select("doc_id")


@query("p09_keyword_annotation", C.with_ctes(C.NEWS, select="""
SELECT * FROM (SELECT doc_id, array_to_string(list_filter(['and','der','que'], lambda k: contains(title || ' ' || content, k)), ',') AS matched FROM news) WHERE matched <> ''"""))
def p09(spark, sf):
    out = N.annotate_keywords(raw(spark, sf), ("que", "and", "der"), hard_filter=True)
    return out.select("doc_id", F.array_join("matched_keywords", ",").alias("matched"))


@query("p16_drop_analysis", C.with_ctes(C.NEWS, NORMAL, select="SELECT doc_id, title, publish_date_bj FROM norm"))
def p16(spark, sf):
    cut = N.drop_analysis(enriched(spark, sf))
    assert not set(cut.columns) & {"news_score", "risk_flags", "news_tier"}
    return cut.select("doc_id", "title", "publish_date_bj")


@query("p17_list_columns", C.with_ctes(C.NEWS, NORMAL, ENRICH, select="SELECT id, source, title, publish_time, publish_time_bj, source_time, crawled_at, collected_at, stock_code, stock_name, announcement_type, url, url AS source_urls FROM enr"))
def p17(spark, sf):
    return N.list_columns(N.with_item_id(normalized(spark, sf))).withColumn("source_urls", F.array_join("source_urls", ","))


PAGE_ORDER = "ORDER BY bj DESC, id"


@query("k04_newest_first", C.with_ctes(C.NEWS, NORMAL, ENRICH, select=f"SELECT doc_id, id, publish_time_bj FROM enr {PAGE_ORDER} LIMIT 100"))
def k04(spark, sf):
    n = N.with_item_id(normalized(spark, sf))
    return n.orderBy(*N.newest_first(n)).limit(100).select("doc_id", "id", "publish_time_bj")


@query("k06_cursor_page", C.with_ctes(C.NEWS, NORMAL, ENRICH, select=f"""
SELECT doc_id, id, (SELECT count(*) FROM enr) AS expected_count, CASE WHEN 350 < (SELECT count(*) FROM enr) THEN 350 END AS next_offset,
 350 >= (SELECT count(*) FROM enr) AS is_complete FROM enr {PAGE_ORDER} LIMIT 150 OFFSET 200"""))
def k06(spark, sf):
    n = N.with_item_id(normalized(spark, sf))
    return N.page(n, N.newest_first(n), 200, 150).select("doc_id", "id", "expected_count", "next_offset", "is_complete")


@query("k06_page_after", C.with_ctes(C.NEWS, NORMAL, ENRICH, select="""
, t AS (SELECT doc_id, id, CASE WHEN doc_id % 10 > 0 THEN publish_time_bj END AS shown FROM enr)
SELECT doc_id, id, shown FROM t ORDER BY shown DESC NULLS LAST, id LIMIT 150 OFFSET (SELECT count(shown) - 49 FROM t)"""))
def k06_after(spark, sf):
    """The 150 items after a known one, fifty places before the first without a time."""
    shown = F.when(F.col("doc_id") % 10 > 0, F.col("publish_time_bj"))
    items = N.with_item_id(normalized(spark, sf)).select("doc_id", "id", shown.alias("shown"))
    place = items.where(F.col("shown").isNotNull()).count() - 50
    known = items.orderBy(F.desc_nulls_last("shown"), "id").offset(place).limit(1).first()
    return N.page_after(items, [("shown", True), ("id", False)], [known.shown, known.id], 150)


@query("c21_item_detail", C.with_ctes(C.NEWS, NORMAL, ENRICH, select="SELECT doc_id, id, title, content FROM enr WHERE id = (SELECT max(id) FROM enr)"))
def c21(spark, sf):
    n = N.with_item_id(normalized(spark, sf))
    return n.where(F.col("id") == n.groupBy().agg(F.max("id")).scalar()).select("doc_id", "id", "title", "content")


def _theme_cond(words):
    return " OR ".join(f"contains(lower(title || ' ' || content || ' ' || stock_name || ' ' || stock_code), '{w.lower()}')" for w in words)


THEMED = "themed AS (" + " UNION ALL ".join(f"SELECT *, '{t}' AS theme FROM enr WHERE {_theme_cond(w)}" for t, w in THEMES.items()) + ")"


@query("a10_theme_heat", C.with_ctes(C.NEWS, NORMAL, ENRICH, THEMED, select="SELECT theme, count(*) AS n_items, arg_max(title, row(publish_time_bj, id)) AS latest_title FROM themed GROUP BY 1"))
def a10(spark, sf):
    return N.theme_heat(N.with_item_id(normalized(spark, sf)), THEMES)


@query("j10_theme_matches", C.with_ctes(C.NEWS, NORMAL, ENRICH, THEMED, select="SELECT theme, doc_id FROM themed"))
def j10(spark, sf):
    return N.theme_matches(normalized(spark, sf), THEMES).select("theme", "doc_id")


@query("a11_source_counts", C.with_ctes(C.NEWS, select="SELECT source, count(*) AS n_items FROM news GROUP BY 1"))
def a11(spark, sf):
    return raw(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n_items"))


FIRST = "firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, trim(title), url ORDER BY doc_id) AS rn FROM enr WHERE trim(title) <> '') WHERE rn = 1)"


@query("c25_news_summary", C.with_ctes(C.NEWS, NORMAL, ENRICH, FIRST, THEMED.replace("FROM enr", "FROM firsts"), select="""
SELECT 'source' AS section, source AS name, count(*) AS n FROM firsts GROUP BY 2 UNION ALL SELECT 'theme', theme, count(*) FROM themed GROUP BY 2
UNION ALL SELECT 'risk', risk_level, count(*) FROM firsts WHERE risk_level <> 'none' GROUP BY 2 UNION ALL SELECT 'tier', news_tier, count(*) FROM firsts GROUP BY 2"""))
def c25(spark, sf):
    """Section counts of the distinct items, in one pass: every item is unpivoted into its sections."""
    e = N.distinct_items(enriched(spark, sf).select("doc_id", "source", "title", "url", "content", "stock_name", "stock_code", "risk_level", "news_tier"), "doc_id")
    tag = lambda section, col: F.struct(F.lit(section).alias("section"), F.col(col).alias("name"))
    risk = F.when(F.col("risk_level") != "none", tag("risk", "risk_level"))
    plain = e.select(F.explode(F.array_compact(F.array(tag("source", "source"), tag("tier", "news_tier"), risk))).alias("s")).select("s.*")
    themes = N.theme_matches(e, THEMES).select(F.lit("theme").alias("section"), F.col("theme").alias("name"))
    return plain.unionByName(themes).groupBy("section", "name").agg(F.count(F.lit(1)).alias("n"))


# --- keywords --------------------------------------------------------------------------------------------

WORDS: dict[str, int] = {}
for _p in PLATES.values():
    for _w in _p:
        WORDS[_w] = WORDS.get(_w, 0) + 1
KW = "kw0 AS (SELECT *, title || ' ' || content AS txt FROM news), kw1 AS (SELECT *, list_sort(list_filter([" + ",".join(
    f"row(-((length(txt) - length(replace(txt, '{w}', ''))) // {len(w)}) * {n}, {i}, '{w}')" for i, (w, n) in enumerate(WORDS.items())
) + "], lambda x: x[1] < 0)) AS found FROM kw0), kw AS (SELECT *, list_transform(found[1:{n}], lambda x: x[3]) AS keywords FROM kw1)"
PL = "pl AS (SELECT *, list_filter([" + ",".join(
    "CASE WHEN list_has_any(keywords, [" + ",".join(f"'{w}'" for w in PLATES[p]) + f"]) THEN '{p}' END" for p in sorted(PLATES)
) + "], lambda x: x IS NOT NULL) AS plates FROM kw)"
KW4, KW20 = KW.replace("{n}", "4"), KW.replace("{n}", "20")


@query("k09_top_keywords", C.with_ctes(C.NEWS, KW4, select="SELECT doc_id, array_to_string(keywords, ',') AS keywords FROM kw"))
def k09(spark, sf):
    return W.analyze(raw(spark, sf), 4, PLATES).select("doc_id", F.array_join("keywords", ",").alias("keywords"))


@query("c26_keyword_analysis", C.with_ctes(C.NEWS, KW20, PL, select="SELECT doc_id, len(keywords)::int AS keyword_count, array_to_string(plates, ',') AS plates FROM pl"))
def c26(spark, sf):
    return W.analyze(raw(spark, sf), 20, PLATES).select("doc_id", F.size("keywords").alias("keyword_count"), F.array_join("plates", ",").alias("plates"))


@query("a06_keyword_frequency", C.with_ctes(C.NEWS, KW4, select="SELECT keyword, count(*) AS n_items FROM (SELECT unnest(keywords) AS keyword FROM kw) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"))
def a06(spark, sf):
    return W.keyword_frequency(W.analyze(raw(spark, sf), 4, PLATES)).orderBy(F.desc("n_items"), "keyword").limit(20)


@query("a07_plate_distribution", C.with_ctes(C.NEWS, KW4, PL, select="SELECT plate, count(*) AS n_items FROM (SELECT unnest(plates) AS plate FROM pl) GROUP BY 1"))
def a07(spark, sf):
    return W.plate_distribution(W.analyze(raw(spark, sf), 4, PLATES))


STAMP = "CASE doc_id % 5 WHEN 2 THEN NULL ELSE timestamp '2024-01-01' + to_minutes(37 * doc_id) END"


@query("a08_high_frequency_topics", C.with_ctes(C.NEWS, KW4, select=f"""
, f AS (SELECT keyword, count(*) AS n_items FROM (SELECT unnest(keywords) AS keyword FROM kw) GROUP BY 1),
s AS (SELECT (epoch_us(max({STAMP})) - epoch_us(min({STAMP}))) / 3600000000.0 AS hours FROM news)
SELECT keyword, n_items FROM f, s WHERE CASE WHEN hours <= 24 THEN n_items > 5 ELSE n_items / greatest(1.0, hours) * 24 > 5 END"""))
def a08(spark, sf):
    return W.high_frequency_topics(W.analyze(raw(spark, sf), 4, PLATES), window_hours=24)


@query("a09_time_range", C.with_ctes(C.NEWS, select=f"SELECT strftime(min({STAMP}), '%Y-%m-%d %H:%M:%S') AS \"start\", strftime(max({STAMP}), '%Y-%m-%d %H:%M:%S') AS \"end\" FROM news"))
def a09(spark, sf):
    return W.time_range(raw(spark, sf)).select(times.ntz_text("start").alias("start"), times.ntz_text("end").alias("end"))
