"""Decoders of vendor payloads held in string columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions.codes import exchange_symbol, zero_padded
from tapeline.functions.numbers import first_text, num_null
from tapeline.functions.text import absolute_url, market_relevant, split_list
from tapeline.functions.times import bind, many_formats
from tapeline.operators.scaling import top_n

# Positions of a comma-separated daily line.
KLINE_FIELDS = ("session", "open", "close", "high", "low", "volume", "amount", "amplitude", "pct", "change", "turnover")


def decode_klines(payloads: DataFrame, doc: str = "payload", code: str = "code", name: str = "name") -> DataFrame:
    """Comma lines to bars. Previous close comes from the change, else from the percentage. Codes are padded, never cut."""
    parsed = payloads.withColumn("_d", F.from_json(doc, "data struct<code: string, name: string, klines: array<string>>")["data"])
    rows = parsed.select(
        zero_padded(first_text("_d.code", code)).alias("code"), first_text("_d.name", name).alias("name"), F.explode("_d.klines").alias("_line")
    ).withColumn("_f", F.split("_line", ","))
    rows = rows.where(F.size("_f") >= len(KLINE_FIELDS))
    cells = [F.get("_f", F.lit(0)).alias("session")] + [num_null(F.get("_f", F.lit(i))).alias(c) for i, c in enumerate(KLINE_FIELDS) if i]
    out = rows.select("code", "name", *cells)
    close, change, pct = F.col("close"), F.col("change"), F.col("pct")
    prev = F.when(change.isNotNull(), close - change).when(pct != -100, close / (1 + pct / 100))
    return out.withColumn("prev_close", F.round(prev, 4))


def decode_array_klines(payloads: DataFrame, doc: str = "payload", code: str = "code", name: str = "name") -> DataFrame:
    """Array lines under the exchange symbol; previous close is the last known close of the payload."""
    lines = "array<array<string>>"
    parsed = payloads.withColumn("_m", F.from_json(doc, f"data map<string, struct<qfqday: {lines}, day: {lines}>>")["data"])
    entry = F.try_element_at("_m", exchange_symbol(code))
    some = lambda a: F.when(F.size(a) > 0, a)
    rows = parsed.withColumn("_e", entry).select(code, name, F.posexplode(F.coalesce(some(F.col("_e.qfqday")), F.col("_e.day"))).alias("_i", "_f"))
    rows = rows.where(F.size("_f") >= 6)
    f = lambda i: num_null(F.get("_f", F.lit(i)))
    out = rows.select(
        F.col(code).alias("code"), F.col(name).alias("name"), "_i", F.get("_f", F.lit(0)).alias("session"),
        f(1).alias("open"), f(2).alias("close"), f(3).alias("high"), f(4).alias("low"), f(5).alias("volume"), f(6).alias("amount"),
    )
    # A payload holds at most one line per session, so the window is bounded by the calendar.
    w = Window.partitionBy("code").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("prev_close", F.last("close", ignorenulls=True).over(w))
    change = F.col("close") - F.col("prev_close")
    return out.withColumns({"change": F.round(change, 4), "pct": F.round(change / F.nullif(F.col("prev_close"), F.lit(0.0)) * 100, 4)}).drop("_i")


def _containers(doc: Column, paths: Sequence[str]) -> Column:
    """First non-empty list among the paths, or the document itself when it is a list; entries as text maps."""
    shape = "array<map<string,string>>"

    def read(text: Column) -> Column:
        lists = [F.from_json(F.get_json_object(text, "$." + p), shape) for p in paths]
        lists.append(F.from_json(F.when(F.trim(text).startswith("["), text), shape))
        return F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])

    return bind(doc, read)


def _item(*keys: str) -> Column:
    """First non-empty of the item's fields, null when there is none."""
    return F.coalesce(*[F.nullif(F.try_element_at("_m", F.lit(k)), F.lit("")) for k in keys])


def decode_roll_news(responses: DataFrame, doc: str = "response", category: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """Roll-news responses to items; untitled items fall back to brief and content, items without any are dropped."""
    paths = ("data.items", "data.list", "data.roll_data", "data", "items", "list")
    rows = responses.select(*keep, F.explode(_containers(F.col(doc), paths)).alias("_m"))
    title = F.coalesce(_item("title"), _item("brief"), F.nullif(F.substring(_item("content"), 1, 50), F.lit("")))
    tags = split_list(F.coalesce(_item("tags", "keywords"), F.lit("")))
    if category:
        tags = F.concat(tags, F.array(F.lit(category)))
    out = rows.select(
        *keep, F.lit("cls").alias("source"), title.alias("title"),
        many_formats(_item("ctime", "publish_time", "time", "createTime", "pubDate")).alias("publish_time"),
        F.coalesce(_item("content", "description", "summary", "brief"), F.lit("")).alias("content"),
        F.coalesce(_item("url", "shareurl", "share_url"), F.lit("")).alias("url"),
        tags.alias("tags"), split_list(F.coalesce(_item("plate", "plates", "sector"), F.lit(""))).alias("plate"),
        F.coalesce(_item("level", "importance"), F.lit("")).alias("level"),
    )
    return out.where(F.col("title").isNotNull())


def decode_announcements(responses: DataFrame, doc: str = "response", base_url: str = "http://www.cninfo.com.cn", keep: Sequence[str] = ()) -> DataFrame:
    """Announcement responses to items; code, name and title are required."""
    paths = ("announcements", "data.announcements", "data.records", "data", "records", "list")
    rows = responses.select(*keep, F.explode(_containers(F.col(doc), paths)).alias("_m"))
    out = rows.select(
        *keep, F.lit("cninfo").alias("source"),
        F.trim(_item("secCode", "stockCode", "code", "stock_code")).alias("stock_code"),
        F.trim(_item("secName", "stockName", "name", "stock_name")).alias("stock_name"),
        F.trim(_item("announcementTitle", "title", "announcementName")).alias("title"),
        many_formats(_item("announcementTime", "publishTime", "publish_time", "pubDate", "announcementDate")).alias("publish_time"),
        F.trim(F.coalesce(_item("announcementType", "type", "category"), F.lit(""))).alias("announcement_type"),
        F.trim(absolute_url(_item("adjunctUrl", "url", "pdfUrl", "announcementUrl"), base_url)).alias("url"),
        split_list(F.coalesce(_item("keywords", "keyword", "tags"), F.lit("")), ",;").alias("keywords"),
    )
    return out.where(F.col("stock_code").isNotNull() & F.col("stock_name").isNotNull() & F.col("title").isNotNull())


def normalize_flash_news(rows: DataFrame, title: str = "title", summary: str = "summary", time: str = "publish_time", url: str = "url") -> DataFrame:
    """Global flash rows: title required, summary doubles as content, a URL is made up where none is given."""
    t, s = F.trim(F.coalesce(title, F.lit(""))), F.trim(F.coalesce(summary, F.lit("")))
    stamp = many_formats(time)
    link = F.trim(F.coalesce(url, F.lit("")))
    out = rows.select(
        *[c for c in rows.columns if c not in (title, summary, time, url)],
        F.lit("eastmoney_global").alias("source"), t.alias("title"), stamp.alias("publish_time"), s.alias("content"), s.alias("summary"),
        F.coalesce(F.nullif(link, F.lit("")), F.concat(F.lit("eastmoney_global://"), t, F.lit("/"), stamp)).alias("url"),
        F.array(F.lit("东方财富"), F.lit("全球财经快讯")).alias("tags"),
    )
    return out.where(F.col("title") != "")


def note_references(responses: DataFrame, doc: str = "response", source_name: str = "source_name", limit: int = 5, page: str | None = None) -> DataFrame:
    """Relevant notes of social search responses, at most ``limit`` per source in response order; ``page`` orders responses."""
    card = (
        "struct<display_title: string, title: string, desc: string, tag_list: array<struct<name: string>>, corner_tag_info: array<struct<text: string>>, "
        "user: struct<nickname: string, nick_name: string>>"
    )
    shape = f"data struct<items: array<struct<id: string, model_type: string, xsec_token: string, note_card: {card}>>>"
    rows = responses.withColumn("_items", F.from_json(doc, shape)["data"]["items"])
    rows = rows.select(source_name, (F.col(page) if page else F.lit(0)).alias("_page"), F.posexplode("_items").alias("_i", "n"))
    c = "n.note_card."
    author = first_text(c + "user.nickname", c + "user.nick_name")
    title = first_text(c + "display_title", c + "title")
    time_text = F.array_join(F.transform(F.col(c + "corner_tag_info"), lambda x: x["text"]), " ")
    tags = F.array_join(F.transform(F.col(c + "tag_list"), lambda x: x["name"]), " ")
    text = F.concat_ws(" ", *[F.nullif(F.coalesce(x, F.lit("")), F.lit("")) for x in (title, F.col(c + "desc"), tags, time_text, author)])
    rows = rows.select(source_name, "_page", "_i", "n", author.alias("_author"), title.alias("title"), text.alias("_text"), time_text.alias("publish_time_text"))
    filled = lambda x: F.coalesce(F.col(x), F.lit("")) != ""
    kept = rows.where(
        (F.col("n.model_type") == "note") & filled("n.id") & filled("n.xsec_token") & market_relevant("_text")
        & ((F.coalesce(source_name, F.lit("")) == "") | (F.col("_author") == "") | F.col("_author").contains(F.col(source_name)))
    )
    best = top_n(kept, [source_name], [F.asc("_page"), F.asc("_i"), F.asc("n.id")], limit)
    url = F.concat(F.lit("https://www.xiaohongshu.com/explore/"), F.col("n.id"), F.lit("?xsec_token="), F.col("n.xsec_token"), F.lit("&xsec_source=pc_search"))
    return best.select(
        source_name, "rank", F.col("n.id").alias("id"), F.col("n.xsec_token").alias("xsec_token"), url.alias("url"), "title",
        F.coalesce("publish_time_text", F.lit("")).alias("publish_time_text"),
    )
