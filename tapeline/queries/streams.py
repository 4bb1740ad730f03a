"""Streaming queries: the whole table is landed as files, drained by a stream, and the result checked as a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.operators import asof
from tapeline.operators.collectors import collector_state
from tapeline.plans import replay as P
from tapeline.queries import ctes as C
from tapeline.queries.news import KW20, LEVEL, NORMAL, PLATES, normalized
from tapeline.queries.registry import CHECKS, query
from tapeline.queries.replay import PANEL
from tapeline.queries.state import CHANGES, STATE, STREAK
from tapeline.session import staged, work_path
from tapeline.sources import driver_tables as D
from tapeline.streaming import keyed as K
from tapeline.streaming import levels as U
from tapeline.streaming import news as S
from tapeline.streaming import state as T


def land(spark, df, files: int | None = None):
    """Write a table as JSON files and open it as a stream."""
    path = work_path(spark, "landing")
    (df if files == 4 else df.repartition(files) if files else df).write.json(path)
    return path


def stream(spark, df, files=None, max_files=None):
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return S.landing_stream(spark, land(spark, df, files), schema, max_files)


def dealt(spark, df, key, batches=4):
    """A stream of so many batches, to which the rows are dealt by a hash, so that they come late and out of order.

    They land as Parquet, which takes less than a tenth of the same rows as JSON, and each batch in as many files as the table is read in: rows are not
    shuffled to be dealt. Rows of a ``key`` lie together in a file, so that what a batch shuffles by it compresses to about half.
    """
    path, batch = work_path(spark, "landing"), F.pmod(hash_of(df), F.lit(batches))
    for k in range(batches):
        df.where(batch == k).sortWithinPartitions(*key).write.mode("append").option("compression", "zstd").parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    return S.landing_stream(spark, path, ", ".join(f"`{c}` {t}" for c, t in df.dtypes), -(-files // batches), "parquet")


def drained(spark, df, mode="append"):
    out = work_path(spark, "out")
    S.run_to_parquet(df, out, work_path(spark, "cp"), mode)
    return spark.read.parquet(out)


def hash_of(df):
    return F.xxhash64(*[F.col(c) for c, t in df.dtypes if t in ("string", "bigint", "double", "timestamp")])


def shuffled(df, parts=4):
    """The rows in an order that has nothing to do with their times, so that batches come late and out of order."""
    return df.repartition(parts, hash_of(df))


def beijing(instant: str):
    return F.convert_timezone(F.current_timezone(), F.lit("Asia/Shanghai"), F.col(instant).cast("timestamp_ntz")).cast("string")


NEWS_COLUMNS = ("doc_id", "source", "title", "content", "url", "publish_time", "stock_code", "collected_at", "crawled_at", "publish_time_bj", "publish_date_bj", "latency_minutes", "source_urls")
KEY = "CASE WHEN source = 'cninfo' THEN stock_code || '|' || title || '|' || publish_time ELSE url END"


def news_rows(spark, sf):
    return normalized(spark, sf).select(*NEWS_COLUMNS)


@query("r01_news_ingest", C.with_ctes(C.NEWS, NORMAL, select="SELECT doc_id, source, publish_time_bj FROM norm"))
def r01(spark, sf):
    return drained(spark, stream(spark, news_rows(spark, sf))).select("doc_id", "source", "publish_time_bj")


@query("s22_landing_ingest", C.with_ctes(C.NEWS, NORMAL, select="SELECT source, count(*) AS n FROM norm GROUP BY 1"))
def s22(spark, sf):
    return drained(spark, stream(spark, news_rows(spark, sf), 4, 1)).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def in_batches(spark, df, batch, drain, n=4):
    """Lands the rows of batch 0, 1 and so on, in as many files as they are read from, and drains the stream after each: what lands together is one batch."""
    path, rows = work_path(spark, "landing"), staged(df, "batches")
    for k in range(n):
        rows.where(batch == k).write.mode("append").json(path)
        drain(S.landing_stream(spark, path, ", ".join(f"`{c}` {t}" for c, t in df.dtypes)))


ITEM_FIELDS = ("doc_id", "source", "title", "content", "url", "publish_time", "stock_code", "collected_at")
ALL_TIME = "20000 days"


@query("r02_watermark_overlap", C.with_ctes(C.NEWS, NORMAL, select=f"""
, b AS (SELECT *, {KEY} AS item_key, doc_id % 4 AS batch, collected - interval 8 hour AS event_time FROM norm),
w AS (SELECT batch, max(max(event_time)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - interval 10 minute AS watermark FROM b GROUP BY batch),
r AS (SELECT *, coalesce(event_time < watermark, false) AS late FROM b JOIN w USING (batch))
SELECT doc_id, CASE WHEN late THEN 'late' ELSE 'first' END AS route, strftime(collected, '%Y-%m-%d %H:%M:%S') AS event_time
FROM r WHERE late OR doc_id = (SELECT min(doc_id) FROM r q WHERE q.item_key = r.item_key AND NOT q.late)"""))
def r02(spark, sf):
    """Rows are dealt to four batches by doc_id, so most come after the watermark of ten minutes: those are routed aside."""
    store, checkpoint, rows = work_path(spark, "watermark"), work_path(spark, "cp"), news_rows(spark, sf)
    in_batches(spark, rows, F.pmod("doc_id", F.lit(4)), lambda landed: S.keep_distinct(landed, store, checkpoint, "doc_id", hold=ALL_TIME))
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    sides = [K.distinct_items(spark, store, schema).withColumn("route", F.lit("first")), K.late_rows(spark, store, schema).withColumn("route", F.lit("late"))]
    out = sides[0].unionByName(sides[1]).withColumn("event_time", S.event_time("collected_at"))
    return out.select("doc_id", "route", F.substring(beijing("event_time"), 1, 19).alias("event_time"))


@query("r03_stream_dedup", C.with_ctes(C.NEWS, NORMAL, select=f"""
SELECT sha256({KEY}) AS item_hash, {", ".join(f"arg_min({c}, doc_id) AS {c}" if c != "doc_id" else "min(doc_id) AS doc_id" for c in ITEM_FIELDS)} FROM norm GROUP BY {KEY}"""))
def r03(spark, sf):
    """Four shuffled batches; the watermark waits so long that no row is late."""
    store, rows = work_path(spark, "distinct"), news_rows(spark, sf)
    S.keep_distinct(stream(spark, shuffled(rows), 4, 1), store, work_path(spark, "cp"), "doc_id", delay=ALL_TIME)
    return K.distinct_items(spark, store, ", ".join(f"{c} {t}" for c, t in rows.dtypes)).select(F.col("item_key").alias("item_hash"), *ITEM_FIELDS)


@query("r04_late_rows", C.with_ctes(C.NEWS, NORMAL, select=f"SELECT CASE WHEN latency_minutes > 180 THEN 'late' ELSE 'on_time' END AS route, {LEVEL} AS latency_level, count(*) AS n FROM norm GROUP BY 1, 2"))
def r04(spark, sf):
    path = work_path(spark, "late")
    S.split_late(stream(spark, news_rows(spark, sf)), path, work_path(spark, "cp"))
    side = lambda r: spark.read.parquet(f"{path}/{r}").groupBy("latency_level").agg(F.count(F.lit(1)).alias("n")).withColumn("route", F.lit(r))
    return side("late").unionByName(side("on_time"))


@query("r05_keyword_windows", C.with_ctes(C.NEWS, NORMAL.replace("norm AS", "norm AS"), KW20.replace("FROM news)", "FROM norm)"), select="""
, w AS (SELECT time_bucket(interval 1 day, collected) AS window_start, unnest(keywords) AS keyword FROM kw)
SELECT strftime(window_start, '%Y-%m-%d') AS window_start, keyword, count(*) AS n_items FROM w
WHERE window_start + interval 1 day <= (SELECT max(collected) - interval 10 minute FROM norm) GROUP BY 1, 2 HAVING count(*) > 5"""))
def r05(spark, sf):
    """Beijing day windows; a window closes once event time has passed its end by the overlap."""
    store = work_path(spark, "keywords")
    S.keep_keyword_counts(spark, stream(spark, shuffled(news_rows(spark, sf)), 4, 1), store, work_path(spark, "cp"), PLATES, window="1 day", start="16 hours")
    out = S.keyword_windows(spark, store)
    return out.select(F.substring(beijing("window_start"), 1, 10).alias("window_start"), "keyword", "n_items")


@query("r06_collector_health_state", C.with_ctes(C.RUN_LOG, STREAK, STATE, select="SELECT source, consecutive_failures, last_error, strftime(last_success_at, '%Y-%m-%d %H:%M:%S') AS last_success_at FROM state"))
def r06(spark, sf):
    log = D.run_log(spark, sf).select("source", F.col("ts").cast("timestamp").alias("ts"), "ok", "error", "base_interval")
    store = work_path(spark, "health")
    T.keep_collector_health(spark, stream(spark, shuffled(log), 4, 1), store, work_path(spark, "cp"))
    state = collector_state(T.latest_version(spark, store).withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    return state.select("source", "consecutive_failures", "last_error", F.substring(F.col("last_success_at").cast("string"), 1, 19).alias("last_success_at"))


@query("r07_holdings_state", CHECKS["c17_holdings"])
def r07(spark, sf):
    """Positions kept by the stream; the check is that of the batch fold."""
    t = D.trades(spark, sf).select("account", "code", "name", "side", "quantity", "price", F.col("at").cast("timestamp").alias("at"), "seq.*")
    store, order = work_path(spark, "holdings"), [F.unix_micros(F.col("l_shipdate").cast("timestamp")), *map(F.col, ("l_orderkey", "l_linenumber", "l_partkey"))]
    T.keep_holdings(dealt(spark, t, ["account", "code"]), order, store, work_path(spark, "cp"), delay=ALL_TIME)
    return T.present_holdings(spark, store).select("account", "code", "quantity", "average_cost", "trades", "rejected")


@query("r08_intraday_stream", C.with_ctes(C.TICKS, CHANGES, select="SELECT code, market_date, strftime(captured_at, '%H:%M:%S') AS captured_at, price_change_from_previous, price_change_from_first, amount_change_from_first FROM chg"))
def r08(spark, sf):
    t = D.ticks(spark, sf).withColumn("captured_at", F.col("captured_at").cast("timestamp"))
    store = work_path(spark, "intraday")
    T.keep_intraday(spark, stream(spark, shuffled(t), 4, 1), store, work_path(spark, "cp"))
    out = spark.read.parquet(f"{store}/changes")
    return out.select(
        "code", "market_date", F.substring(F.col("captured_at").cast("string"), 12, 8).alias("captured_at"), "price_change_from_previous", "price_change_from_first",
        "amount_change_from_first",
    )


@query("r09_stream_upsert", C.with_ctes(C.NEWS, NORMAL, f"m0 AS (SELECT *, {KEY} AS item_key FROM norm)", select="""
SELECT source, publish_date_bj, item_key, min(collected_at) AS collected_at, array_to_string(list_sort(list_distinct(list(url))), ',') AS urls FROM m0 GROUP BY 1, 2, 3"""))
def r09(spark, sf):
    """Batches become fragments that merge by size; every second one publishes the days that it and the one before it touch."""
    held, store = work_path(spark, "fragments"), work_path(spark, "store")
    n = news_rows(spark, sf).withColumn("arrival", F.col("doc_id"))
    U.keep_upserts(stream(spark, shuffled(n), 4, 1), held, store, work_path(spark, "cp"), "arrival", publish_every=2)
    out = spark.read.parquet(store)
    return out.select("source", F.col("publish_date_bj").cast("string").alias("publish_date_bj"), "item_key", "collected_at", F.array_join(F.array_sort("source_urls"), ",").alias("urls"))


@query("r10_messages_to_decisions", C.with_ctes(PANEL, C.MESSAGES.replace(C.NAMES + ",", ""), select="""
SELECT d.mode, d.decision_no, m.kind, m.doc_id FROM messages m JOIN decisions d ON m.stamp BETWEEN d.lower AND d.cutoff"""))
def r10(spark, sf):
    d = asof.decisions(P.market_sessions(D.bars(spark, sf)))
    m = D.messages(spark, sf).select("doc_id", "kind", "stamp")
    return drained(spark, S.visible_to_decisions(stream(spark, m), d)).select("mode", "decision_no", "kind", "doc_id")
