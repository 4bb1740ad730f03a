"""Adapters: the driver's Parquet tables seen as bars, snapshots, news, trades, run logs and journals.

Every adapter reads its whole table. Prices are rescaled to the size of share prices so that the default
thresholds of the rules apply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeline.functions.times import add_minutes, iso_text, ntz_text
from tapeline.operators.scaling import ordered_totals, time_bucket

CODE_PREFIXES = ("000", "600", "300", "002", "688", "601", "003", "920", "603", "001")


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_of(key: Column) -> Column:
    text = key.cast("string")
    prefix = F.get(F.array(*[F.lit(p) for p in CODE_PREFIXES]), (key % 10).cast("int"))
    return F.concat(prefix, F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text))


def price_of(x: Column) -> Column:
    return F.lit(50.0) + x / F.lit(20011.0)


def exact_sum(c: Column | str) -> Column:
    """Decimal sum: the same bits whatever order the rows arrive in."""
    v = F.col(c) if isinstance(c, str) else c
    return F.sum(v.cast("decimal(18,2)")).cast("double")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    mark = F.when(F.col("s_suppkey") % 23 == 0, F.lit("ST")).otherwise(F.lit(""))
    return s.select(F.col("s_suppkey").alias("k"), F.concat(mark, F.col("s_name")).alias("name"))


def session_of(ts: str) -> Column:
    return F.trunc(F.col(ts).cast("date"), "month")


def session_no_of(session: Column) -> Column:
    return (F.year(session) - 1990) * 12 + F.month(session)


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per code and month."""
    li = table(spark, sf_dir, "lineitem")
    at = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    px = F.col("l_extendedprice")
    agg = li.groupBy(F.col("l_suppkey").alias("k"), session_of("l_shipdate").alias("session")).agg(
        F.min_by(px, at).alias("o"),
        F.max_by(px, at).alias("c"),
        F.max(px).alias("h"),
        F.min(px).alias("l"),
        F.sum("l_quantity").alias("q"),
        exact_sum("l_extendedprice").alias("a"),
        exact_sum("l_discount").alias("d"),
        exact_sum("l_tax").alias("t"),
        F.count_if(F.col("l_returnflag") == "R").alias("nr"),
        F.count_if(F.col("l_returnflag") == "A").alias("na"),
        F.count_if(F.col("l_linestatus") == "F").alias("nf"),
        F.count_if(F.col("l_linestatus") == "O").alias("no"),
    )
    w = Window.partitionBy("code").orderBy("session")
    named = agg.join(names(spark, sf_dir), "k", "left")
    shaped = named.select(
        "k",
        code_of(F.col("k")).alias("code"),
        F.coalesce("name", F.lit("")).alias("name"),
        "session",
        session_no_of(F.col("session")).alias("session_no"),
        price_of(F.col("o")).alias("open"),
        price_of(F.col("h")).alias("high"),
        price_of(F.col("l")).alias("low"),
        price_of(F.col("c")).alias("close"),
        (F.col("q") * 100.0).alias("volume"),
        (F.col("a") * 1000.0).alias("amount"),
        (F.col("d") * 10.0).alias("turnover"),
        (F.col("t") * 5.0).alias("volume_ratio"),
        (F.col("nr") - F.col("na")).cast("double").alias("speed"),
        (F.col("nf") - F.col("no")).cast("double").alias("change_5m"),
    ).withColumn("prev_close", F.lag("close").over(w))
    return shaped.withColumns(
        {
            "pct": (F.col("close") / F.col("prev_close") - 1.0) * 100.0,
            "amplitude": (F.col("high") - F.col("low")) / F.col("prev_close") * 100.0,
        }
    )


def snapshot_of(session: Column) -> Column:
    return F.concat(F.lit("snap-"), F.replace(session.cast("string"), F.lit("-"), F.lit("")))


def spot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cross-section per month, with the fields of a quote."""
    b = bars(spark, sf_dir)
    return b.select(
        snapshot_of(F.col("session")).alias("snapshot_id"),
        "*",
        (F.col("amount") * 50.0).alias("float_cap"),
        (F.col("amount") * 80.0).alias("total_cap"),
    )


POOLS = ("limit_up", "previous_limit_up", "strong", "broken_limit")


def pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pool membership rows from orders: pool by order key, industry by priority."""
    o = table(spark, sf_dir, "orders")
    key = F.floor(F.col("o_custkey") / 15).cast("bigint")
    return o.select(
        snapshot_of(session_of("o_orderdate")).alias("snapshot_id"),
        session_of("o_orderdate").alias("session"),
        F.get(F.array(*[F.lit(p) for p in POOLS]), (F.col("o_orderkey") % 4).cast("int")).alias("pool"),
        code_of(key).alias("code"),
        F.concat(F.lit("Pool#"), key.cast("string")).alias("name"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("")).otherwise(F.col("o_orderpriority")).alias("industry"),
        (F.col("o_orderkey") % 21 - 10).cast("double").alias("pct"),
        (F.col("o_orderkey") % 19).cast("double").alias("turnover"),
        (F.col("o_orderkey") % 7 - 3).cast("double").alias("speed"),
        (F.col("o_orderkey") % 14).cast("double").alias("amplitude"),
        (F.col("o_orderkey") % 5).cast("double").alias("volume_ratio"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).otherwise(F.lit("")).alias("reason"),
        F.col("o_orderkey").alias("seq"),
    )


def fund_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed turnover per code and month."""
    li = table(spark, sf_dir, "lineitem")
    px = F.col("l_extendedprice")
    signed = F.when(F.col("l_returnflag") == "R", -px).otherwise(px)
    agg = li.groupBy(F.col("l_suppkey").alias("k"), session_of("l_shipdate").alias("session")).agg(
        exact_sum(signed).alias("net"),
        exact_sum(px).alias("gross"),
        exact_sum(F.when(F.col("l_quantity") >= 40, signed).otherwise(F.lit(0.0))).alias("super"),
        exact_sum(F.when(F.col("l_quantity").between(20, 39), signed).otherwise(F.lit(0.0))).alias("big"),
    )
    return agg.join(names(spark, sf_dir), "k", "left").select(
        snapshot_of(F.col("session")).alias("snapshot_id"),
        code_of(F.col("k")).alias("code"),
        F.coalesce("name", F.lit("")).alias("name"),
        (F.col("net") / F.col("gross") * 10.0).alias("pct"),
        (F.col("net") * 1000.0).alias("main_net"),
        (F.col("net") / F.col("gross") * 15.0).alias("main_net_pct"),
        (F.col("super") * 1000.0).alias("super_net"),
        (F.col("big") * 1000.0).alias("big_net"),
    )


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand boards per month."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_returnflag", "l_suppkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    agg = (
        li.join(part, li.l_partkey == part.p_partkey)
        .groupBy(session_of("l_shipdate").alias("session"), F.col("p_brand").alias("board"))
        .agg(
            exact_sum("l_extendedprice").alias("amount"),
            exact_sum("l_discount").alias("d"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("l_returnflag") == "N").alias("rise_count"),
            F.count_if(F.col("l_returnflag") == "R").alias("fall_count"),
            F.max_by("l_suppkey", F.struct("l_extendedprice", "l_suppkey")).alias("lead"),
            F.max("l_extendedprice").alias("lead_px"),
        )
    )
    return agg.select(
        snapshot_of(F.col("session")).alias("snapshot_id"),
        F.regexp_replace("board", "Brand#", "BK").alias("code"),
        F.col("board").alias("name"),
        ((F.col("rise_count") - F.col("fall_count")) / F.col("n") * 10.0).alias("pct"),
        "amount",
        (F.col("d") / F.col("n")).alias("turnover"),
        F.col("rise_count").cast("double").alias("rise_count"),
        F.col("fall_count").cast("double").alias("fall_count"),
        code_of(F.col("lead")).alias("leader"),
        (F.col("lead_px") / 10000.0).alias("leader_pct"),
    )


NEWS_SOURCES = ("cls", "eastmoney_global", "cninfo", "ndrc")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw news items: title, whole text, source-specific time text and collection time."""
    d = table(spark, sf_dir, "documents")
    n = names(spark, sf_dir).withColumnRenamed("name", "stock_name")
    i = F.col("doc_id")
    src_no = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    source = F.get(F.array(*[F.lit(s) for s in NEWS_SOURCES]), src_no % 4)
    base = d.withColumn("k", i % 100).join(n, "k", "left")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    base = base.select(
        i.alias("doc_id"),
        source.alias("source"),
        F.col("source").alias("channel"),
        F.col("lang").alias("lang"),
        F.col("text").alias("content"),
        F.coalesce("stock_name", F.lit("")).alias("stock_name"),
        code_of(F.col("k")).alias("code6"),
        F.concat(F.lit("doc://"), F.md5("text")).alias("url"),
        add_minutes(start, i * 37).alias("wall"),
        F.regexp_extract("text", r"^[^.\n]+", 0).alias("head"),
    )
    wall = ntz_text("wall")
    dashed_t = F.replace(wall, F.lit(" "), F.lit("T"))
    form = i % 5
    time_text = (
        F.when(form == 0, F.concat(dashed_t, F.lit("Z")))
        .when(form == 1, wall)
        .when(form == 2, F.replace(wall, F.lit("-"), F.lit("/")))
        .when(form == 3, F.concat(dashed_t, F.lit("+00:00")))
        .otherwise(F.substring(wall, 1, 16))
    )
    at_16 = F.substring(wall, 12, 8) == "16:00:00"
    utc = (form == 3) | ((form == 0) & ((F.col("source") == "cls") | ((F.col("source") == "cninfo") & at_16)))
    lag = (i * 7) % 300 - 5
    collected = add_minutes(add_minutes(F.col("wall"), F.when(utc, F.lit(480)).otherwise(F.lit(0))), lag)
    mention = F.when((i % 3 == 0) & (F.col("stock_name") != ""), F.concat(F.col("stock_name"), F.lit(": "))).otherwise(F.lit(""))
    code_text = F.when(i % 7 == 0, F.regexp_replace("code6", "^0+", "")).otherwise(F.col("code6"))
    return base.select(
        "doc_id", "source", "channel", "lang",
        F.concat(mention, F.col("head")).alias("title"),
        "content",
        F.lit("").alias("summary"),
        "url",
        time_text.alias("publish_time"),
        iso_text(collected).alias("crawled_at"),
        code_text.alias("stock_code"),
        "stock_name",
        F.when(F.col("source") == "cninfo", F.col("lang")).otherwise(F.lit("")).alias("announcement_type"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles stamped shortly before month starts, so that they meet the decisions made on bars."""
    d = news(spark, sf_dir)
    i = F.col("doc_id")
    month = F.lit("1995-01-01 15:00:00").cast("timestamp_ntz") + F.make_ym_interval(F.lit(0), (i % 60).cast("int"))
    stamp = add_minutes(month, -((i * 11) % 130) * 60)
    return d.select(
        "doc_id", "source", "title", "stock_code",
        F.when(F.col("source") == "cninfo", F.lit("announcement")).otherwise(F.lit("news")).alias("kind"),
        stamp.alias("stamp"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday observations: price per event and the amount traded so far that day."""
    e = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("code"),
        F.col("ts").cast("date").alias("market_date"),
        F.col("ts").cast("timestamp_ntz").alias("captured_at"),
        F.col("value").alias("price"),
    )
    return ordered_totals(
        e, ["code", "market_date"], time_bucket(F.col("captured_at")), ["captured_at"],
        {"amount": F.col("price").cast("decimal(18,2)")},
    ).withColumn("amount", F.col("amount").cast("double"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buys and sells per account and code with a total order."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_suppkey") % 10).alias("account"),
        F.lpad((F.col("l_partkey") % 200).cast("string"), 6, "0").alias("code"),
        F.concat(F.lit("Part#"), (F.col("l_partkey") % 200).cast("string")).alias("name"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey").alias("seq"),
        F.when(F.col("l_returnflag") == "R", F.lit("sell")).otherwise(F.lit("buy")).alias("side"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("at"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection attempts per source."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("source"), (F.col("user_id") % 10).cast("string")).alias("source"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        ((F.col("event_type") != "error") & (F.col("event_type") != "view")).alias("ok"),
        F.when(F.col("event_type").isin("error", "view"), F.concat(F.col("event_type"), F.lit(" "), F.col("props"))).alias("error"),
        F.lit(60).alias("base_interval"),
        F.floor("value").cast("bigint").alias("fetched"),
        F.floor(F.col("value") / 2).cast("bigint").alias("saved"),
        F.floor(F.col("value") / 4).cast("bigint").alias("duplicates"),
        F.floor(F.col("value") / 8).cast("bigint").alias("filtered"),
        F.when(F.col("event_type") == "error", F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("errors"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journal runs: versions per trade date and mode."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").cast("date").alias("trade_date"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("morning")).otherwise(F.lit("overnight")).alias("mode"),
        F.col("o_orderkey").alias("recorded_at"),
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.col("o_custkey").alias("author"),
        F.col("o_totalprice").alias("size"),
        F.col("o_orderpriority").alias("judgment"),
    )


SNAPSHOT_MODES = ("morning", "midday", "overnight", "custom", "historical")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot metadata rows: two files per id, some without an id, from orders."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    captured = add_minutes(F.col("o_orderdate").cast("timestamp_ntz"), (key * 17) % 1440)
    count = F.floor(F.col("o_totalprice") / 50).cast("bigint")
    return o.select(
        F.when(key % 11 != 0, F.concat(F.lit("S"), F.floor(key / 2).cast("string"))).alias("snapshot_id"),
        F.get(F.array(*[F.lit(m) for m in SNAPSHOT_MODES]), (F.floor(key / 2) % 5).cast("int")).alias("mode"),
        captured.alias("captured_at"),
        F.when(key % 3 != 0, captured).alias("source_time"),
        F.replace(F.col("o_orderdate").cast("date").cast("string"), F.lit("-"), F.lit("")).alias("market_date"),
        (F.col("o_orderstatus") != "P").alias("spot_ok"),
        count.alias("stock_count"),
        F.floor(count * 0.55).cast("bigint").alias("tradeable_stock_count"),
        (key % 2 == 1).alias("is_latest_file"),
        F.concat(F.lit("file-"), key.cast("string")).alias("path"),
        key.alias("seq"),
    )
