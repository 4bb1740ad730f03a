"""Trading calendar queries. Trade dates are the busy order dates; month starts are closed, some Sundays opened."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.functions import times
from tapeline.operators import calendar as K
from tapeline.queries import ctes as C
from tapeline.queries.registry import query
from tapeline.sources import driver_tables as D

CAL = """od AS (SELECT o_orderdate::date AS date, count(*) AS n FROM orders GROUP BY 1),
cached AS (SELECT date FROM od WHERE n >= 5), closed AS (SELECT date FROM od WHERE day(date) = 1), opened AS (SELECT date FROM od WHERE day(date) = 15 AND dayofweek(date) = 0),
days AS (SELECT unnest(generate_series((SELECT min(date) FROM od)::timestamp, (SELECT max(date) FROM od)::timestamp, interval 1 day))::date AS date),
dim0 AS (SELECT date, date IN (SELECT date FROM opened) OR (date NOT IN (SELECT date FROM closed) AND dayofweek(date) NOT IN (0, 6)
  AND (date IN (SELECT date FROM cached) OR year(date) = 1997)) AS is_trade_day FROM days),
dim AS (SELECT *, sum(is_trade_day::int) OVER (ORDER BY date) AS session_no,
  max(CASE WHEN is_trade_day THEN date END) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_trade_day,
  min(CASE WHEN is_trade_day THEN date END) OVER (ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_trade_day FROM dim0)"""


def parts(spark, sf):
    od = D.table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return od, od.where("n >= 5").select("date"), od.where("day(date) = 1").select("date"), od.where("day(date) = 15 AND dayofweek(date) = 1").select("date")


def dim(spark, sf):
    od, cached, closed, opened = parts(spark, sf)
    edge = lambda f: od.groupBy().agg(f("date")).scalar()
    return K.calendar_dim(cached, edge(F.min), edge(F.max), closed, opened, covered_years=(1997,))


@query("u04_calendar_set_algebra", C.with_ctes(CAL, select="SELECT date, is_trade_day, session_no::bigint AS session_no FROM dim"))
def u04(spark, sf):
    return dim(spark, sf).select("date", "is_trade_day", "session_no")


@query("x35_trade_day_test", C.with_ctes(CAL, select="SELECT o_orderkey, is_trade_day FROM orders JOIN dim ON date = o_orderdate::date"))
def x35(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return K.attach_trade_days(o, dim(spark, sf)).select("o_orderkey", "is_trade_day")


@query("j08_neighbour_trade_days", C.with_ctes(CAL, select="""
SELECT o_orderkey, previous_trade_day, CASE WHEN is_trade_day THEN date ELSE previous_trade_day END AS previous_or_current, next_trade_day
FROM orders JOIN dim ON date = o_orderdate::date"""))
def j08(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    out = K.attach_trade_days(o, dim(spark, sf))
    current = F.when(F.col("is_trade_day"), F.col("date")).otherwise(F.col("previous_trade_day"))
    return out.select("o_orderkey", "previous_trade_day", current.alias("previous_or_current"), "next_trade_day")


@query("k07_completed_trade_days", C.with_ctes(CAL, select="""
SELECT * FROM (SELECT 'before close' AS at, date FROM dim WHERE is_trade_day AND date < date '1998-06-17' ORDER BY date DESC LIMIT 20)
UNION ALL SELECT * FROM (SELECT 'after close', date FROM dim WHERE is_trade_day AND date <= date '1998-06-17' ORDER BY date DESC LIMIT 20)"""))
def k07(spark, sf):
    d = dim(spark, sf)
    early = K.completed_trade_days(d, "1998-06-17 14:30:00", 20).withColumn("at", F.lit("before close"))
    return early.unionByName(K.completed_trade_days(d, "1998-06-17 15:20:00", 20).withColumn("at", F.lit("after close")))


@query("w22_session_neighbours", C.with_ctes(C.BARS, select="""
SELECT session, lag(session) OVER (ORDER BY session) AS previous, lead(session) OVER (ORDER BY session) AS next FROM (SELECT DISTINCT session FROM bars)"""))
def w22(spark, sf):
    s = D.bars(spark, sf).select("session").distinct().withColumn("market", F.lit("CN"))
    return K.session_neighbours(s).drop("market")


SLOTS = "(VALUES " + ",".join(f"('{s}','{m}')" for s, m in __import__("tapeline.functions.constants", fromlist=["x"]).SNAPSHOT_SLOTS) + ") sl(slot, mode)"


@query("j17_missing_slots", C.with_ctes(CAL, C.SNAPSHOTS, select=f"""
SELECT date, slot, sl.mode FROM dim, {SLOTS} WHERE is_trade_day
 AND NOT EXISTS (SELECT 1 FROM snapshots s WHERE s.captured_at::date = date AND strftime(s.captured_at, '%H:%M') = slot)"""))
def j17(spark, sf):
    return K.missing_slots(dim(spark, sf), D.snapshots(spark, sf)).select("date", "slot", "mode")


@query("j17_next_slot", C.with_ctes(CAL, C.SNAPSHOTS, select=f"""
SELECT seq, coalesce(t.d, next_trade_day) AS run_date, coalesce(t.s, '09:15') AS slot FROM snapshots JOIN dim ON date = captured_at::date
LEFT JOIN LATERAL (SELECT date AS d, min(slot) AS s FROM {SLOTS} WHERE is_trade_day AND slot > strftime(captured_at, '%H:%M') GROUP BY 1) t ON true"""))
def j17_next(spark, sf):
    t = D.snapshots(spark, sf).select("seq", F.col("captured_at").alias("now"))
    return K.next_slot(dim(spark, sf), t).select("seq", "run_date", "slot")


@query("a26_calendar_summary", C.with_ctes(CAL, select="""
SELECT date AS current_date, is_trade_day, previous_trade_day, next_trade_day, (SELECT count(*) FROM cached) AS trade_date_count,
 (SELECT min(date) FROM cached) AS first_trade_date, (SELECT max(date) FROM cached) AS last_trade_date FROM dim WHERE date = date '1998-06-17'"""))
def a26(spark, sf):
    _, cached, _, _ = parts(spark, sf)
    return K.calendar_summary(dim(spark, sf), cached, "1998-06-17", covered_years=(1997,)).drop("available", "source", "closed_date_count", "open_date_count")


@query("x29_collection_cadence", C.with_ctes(CAL, C.SNAPSHOTS, select="""
, q AS (SELECT seq, captured_at, hour(captured_at) * 60 + minute(captured_at) AS m, is_trade_day AS t,
  list_extract(['cls','eastmoney_global','cninfo','ndrc','other'], (seq % 5 + 1)::int) AS source FROM snapshots JOIN dim ON date = captured_at::date)
SELECT seq, source, (CASE source WHEN 'cls' THEN CASE WHEN t AND m BETWEEN 525 AND 930 THEN 300 ELSE 900 END
 WHEN 'eastmoney_global' THEN CASE WHEN t AND m BETWEEN 525 AND 930 THEN 600 ELSE 1200 END
 WHEN 'cninfo' THEN CASE WHEN t AND m BETWEEN 900 AND 1320 THEN 900 WHEN t AND m BETWEEN 525 AND 930 THEN 1800 ELSE 3600 END
 WHEN 'ndrc' THEN CASE WHEN t THEN 3600 ELSE 7200 END ELSE 120 END)::int AS seconds FROM q"""))
def x29(spark, sf):
    s = D.snapshots(spark, sf).select("seq", "captured_at", F.substring(F.col("captured_at").cast("string"), 1, 10).cast("date").alias("date"))
    src = F.get(F.array(*[F.lit(x) for x in ("cls", "eastmoney_global", "cninfo", "ndrc", "other")]), (F.col("seq") % 5).cast("int"))
    base = F.get(F.array(*[F.lit(x) for x in (300, 600, 1800, 3600, 120)]), (F.col("seq") % 5).cast("int"))
    out = K.attach_trade_days(s, dim(spark, sf)).withColumns({"source": src, "base": base})
    return out.select("seq", "source", times.collection_interval("source", "base", "captured_at", "is_trade_day").alias("seconds"))
