"""Market cross-section queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.functions import codes, constants, numbers, times
from tapeline.functions.hashing import historical_snapshot_id, snapshot_id
from tapeline.operators import market as M
from tapeline.queries import ctes as C
from tapeline.queries.registry import query
from tapeline.sources import driver_tables as D

RESTRICTED = "regexp_matches(code, '^(300|301|688|689|8|4|920)')"
ST = "(upper(name) LIKE '%ST%' OR name LIKE '%退%')"
# Supplier names hold no other "ST"; the adapter adds the mark to some.


@query("p01_tradeable_universe", C.with_ctes(C.SPOT, select=f"""
SELECT snapshot_id, code, name, false AS chinext FROM spot WHERE NOT {RESTRICTED} AND NOT {ST}
UNION ALL SELECT snapshot_id, code, name, true FROM spot
WHERE NOT regexp_matches(code, '^(688|689|8|4|920)') AND NOT {ST}"""))
def p01(spark, sf):
    s = D.spot(spark, sf).select("snapshot_id", "code", "name")
    return M.tradeable_universe(s).withColumn("chinext", F.lit(False)).unionByName(
        M.tradeable_universe(s, allow_chinext=True).withColumn("chinext", F.lit(True))
    )


@query("p02_main_board", C.with_ctes(C.SPOT, select=f"""
SELECT snapshot_id, code, name FROM spot
WHERE substr(code,1,3) IN ('000','001','002','003','600','601','603','605') AND NOT {ST}"""))
def p02(spark, sf):
    return M.main_board_universe(D.spot(spark, sf)).select("snapshot_id", "code", "name")


@query("x05_st_names", C.with_ctes(C.NAMES, select=f"SELECT k, name, {ST} AS is_st FROM names"))
def x05(spark, sf):
    return D.names(spark, sf).withColumn("is_st", codes.is_st_or_delisting("name"))


@query("x03_clean_codes", """SELECT c_custkey AS k, lpad((c_custkey % 1000000)::varchar, 6, '0') AS code, c_mktsegment AS name FROM customer""")
def x03(spark, sf):
    c = D.table(spark, sf, "customer")
    raw = F.concat(
        F.get(F.array(*[F.lit(x) for x in ("sh", "SZ", "bj", "")]), (F.col("c_custkey") % 4).cast("int")),
        F.lpad((F.col("c_custkey") % 1000000).cast("string"), 6, "0"),
    )
    return c.select(
        F.col("c_custkey").alias("k"), codes.clean_code(F.lit(""), raw).alias("code"),
        codes.clean_name(F.lit(None).cast("string"), F.concat(F.lit(" "), "c_mktsegment")).alias("name"),
    )


@query("x04_valid_codes", """SELECT o_orderkey AS k, CASE WHEN length(o_custkey::varchar) <= 6 AND o_orderkey % 5 <> 0
THEN lpad(o_custkey::varchar, 6, '0') END AS code FROM orders""")
def x04(spark, sf):
    raw = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("A"), "o_custkey")).otherwise(F.col("o_custkey").cast("string"))
    return D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), codes.valid_code(raw).alias("code"))


@query("x17_exchange_symbols", C.with_ctes(C.SPOT, select="""
SELECT DISTINCT code, CASE WHEN code[1] IN ('5','6','9') THEN '1' ELSE '0' END AS market,
 CASE WHEN code[1] IN ('4','8') THEN 'bj' WHEN code[1] IN ('5','6','9') THEN 'sh' ELSE 'sz' END || code AS symbol FROM spot"""))
def x17(spark, sf):
    return D.spot(spark, sf).select("code").distinct().select(
        "code", codes.market_prefix("code").alias("market"), codes.exchange_symbol("code").alias("symbol")
    )


@query("x01_number_rules", """
SELECT event_id, coalesce(CASE WHEN event_id % 4 = 1 THEN NULL ELSE value END, event_id::double) AS with_fallback,
 CASE WHEN event_id % 4 IN (0, 2) THEN value WHEN event_id % 4 = 1 THEN NULL ELSE NULL END AS strict,
 coalesce(CASE WHEN event_id % 4 IN (0, 2) THEN value END, 0.0) AS zero,
 event_id % 4 = 3 AS has_inf FROM events""")
def x01(spark, sf):
    e = D.table(spark, sf, "events")
    kind = F.col("event_id") % 4
    text = F.col("value").cast("string")
    raw = F.when(kind == 0, text).when(kind == 1, F.get(F.array(F.lit("-"), F.lit(""), F.lit("1,000"), F.lit("1d")), (F.col("event_id") % 3).cast("int"))).when(
        kind == 2, F.concat(F.lit(" "), text, F.lit(" "))
    ).otherwise(F.lit("inf"))
    loose = F.when(kind == 3, text).otherwise(raw)
    return e.select(
        "event_id",
        numbers.num0(loose, F.col("event_id").cast("string")).alias("with_fallback"),
        numbers.num_null_finite(raw).alias("strict"),
        F.coalesce(numbers.num_null_finite(raw), F.lit(0.0)).alias("zero"),
        F.coalesce(numbers.num_null(raw) == float("inf"), F.lit(False)).alias("has_inf"),
    )


@query("x02_first_text", """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang WHEN doc_id % 3 = 0 THEN source ELSE '' END AS label FROM documents""")
def x02(spark, sf):
    i = F.col("doc_id")
    return D.table(spark, sf, "documents").select(
        "doc_id",
        numbers.first_text(
            F.when(i % 2 == 0, F.col("lang")).otherwise(F.lit("")), F.when(i % 3 == 0, F.col("source"))
        ).alias("label"),
    )


@query("x16_change_and_range", C.with_ctes(C.BARS, select="""
SELECT code, session, CASE WHEN prev_close IS NULL OR prev_close = 0 THEN NULL ELSE (close / prev_close - 1.0) * 100.0 END AS change,
 coalesce(pct BETWEEN -0.8 AND 4.5, false) AS calm FROM bars"""))
def x16(spark, sf):
    b = D.bars(spark, sf)
    return b.select("code", "session", numbers.pct_change("close", "prev_close").alias("change"), numbers.in_range("pct", -0.8, 4.5).alias("calm"))


@query("x32_json_safe", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value FROM events""")
def x32(spark, sf):
    v = F.when(F.col("event_id") % 6 == 0, F.lit(float("nan"))).when(F.col("event_id") % 3 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    return D.table(spark, sf, "events").select("event_id", numbers.finite(v).alias("value"))


@query("p15_compact_rows", C.with_ctes(C.SPOT, C.FLOW, C.BOARDS, select="""
SELECT 'stock' AS kind, snapshot_id, code, name, coalesce(pct, 0.0) AS pct, amount AS size FROM spot
UNION ALL SELECT 'board', snapshot_id, code, name, pct, amount FROM boards
UNION ALL SELECT 'flow', snapshot_id, code, name, pct, main_net FROM flow"""))
def p15(spark, sf):
    keys = ["snapshot_id"]
    stock = M.compact_stocks(D.spot(spark, sf), keys).select(F.lit("stock").alias("kind"), *keys, "code", "name", "pct", F.col("amount").alias("size"))
    board = M.compact_boards(D.boards(spark, sf), keys).select(F.lit("board").alias("kind"), *keys, "code", "name", "pct", F.col("amount").alias("size"))
    flow = M.compact_flows(D.fund_flow(spark, sf), keys).select(F.lit("flow").alias("kind"), *keys, "code", "name", "pct", F.col("main_net").alias("size"))
    return stock.unionByName(board).unionByName(flow)


SUMMARY = f"""
s AS (SELECT snapshot_id, count(*) AS stock_count, count(*) FILTER (NOT {RESTRICTED} AND NOT {ST}) AS tradeable_stock_count,
 count(*) FILTER (pct > 0) AS up_count, count(*) FILTER (pct < 0) AS down_count FROM spot GROUP BY 1),
p AS (SELECT snapshot_id, count(*) FILTER (pool = 'limit_up') AS lu, count(*) FILTER (pool = 'broken_limit') AS bl FROM pools GROUP BY 1),
summary AS (SELECT s.*, coalesce(lu, 0) AS limit_up_count, coalesce(bl, 0) AS broken_limit_count,
 round(up_count / greatest(up_count + down_count, 1), 4) AS market_breadth,
 round(coalesce(bl, 0) / greatest(coalesce(lu, 0) + coalesce(bl, 0), 1), 4) AS broken_limit_ratio
 FROM s LEFT JOIN p USING (snapshot_id))"""


@query("a01_market_summary", C.with_ctes(C.SPOT, C.POOLS, SUMMARY, select="SELECT * FROM summary"))
def a01(spark, sf):
    return M.market_summary(D.spot(spark, sf), D.pools(spark, sf))


INDUSTRY = """
ind AS (SELECT snapshot_id, industry, count(*) FILTER (pool = 'limit_up') AS limit_up_count,
 count(*) FILTER (pool = 'previous_limit_up') AS previous_limit_count, count(*) FILTER (pool = 'strong') AS strong_count,
 count(*) FILTER (pool = 'broken_limit') AS broken_limit_count FROM pools WHERE industry <> '' GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY snapshot_id ORDER BY limit_up_count DESC, previous_limit_count DESC,
 strong_count DESC, broken_limit_count, industry) AS rank FROM ind)"""


@query("a02_pool_industry_counts", C.with_ctes(C.POOLS, INDUSTRY, select="SELECT * FROM ranked"))
def a02(spark, sf):
    return M.pool_industry_counts(D.pools(spark, sf))


@query("a02_pool_industry_leaders", C.with_ctes(C.POOLS, INDUSTRY, select="""
, o AS (SELECT *, row_number() OVER (PARTITION BY snapshot_id, industry ORDER BY list_position(['limit_up','previous_limit_up','strong','broken_limit'], pool), seq) AS r
 FROM pools WHERE industry <> ''),
l AS (SELECT snapshot_id, industry, string_agg(code || '/' || pct::int::varchar, ',' ORDER BY r) AS leaders FROM o WHERE r <= 8 GROUP BY 1, 2)
SELECT ranked.*, leaders FROM ranked JOIN l USING (snapshot_id, industry) WHERE rank <= 100"""))
def a02_leaders(spark, sf):
    out = M.pool_industry_leaders(D.pools(spark, sf))
    flat = F.array_join(F.transform("leaders", lambda x: F.concat_ws("/", x["code"], x["pct"].cast("int").cast("string"))), ",")
    return out.withColumn("leaders", flat)


RANKED_SQL = f"""
rows AS (
 SELECT snapshot_id, code, name, unnest(['top_gainers','top_amount','top_turnover','top_volume_ratio']) AS list,
        unnest([coalesce(pct, 0.0), amount, turnover, volume_ratio]) AS value, 50 AS size FROM spot WHERE NOT {RESTRICTED} AND NOT {ST}
 UNION ALL SELECT snapshot_id, code, name, 'top_industries', pct, 50 FROM boards
 UNION ALL SELECT snapshot_id, code, name, 'top_concepts', pct, 80 FROM boards
 UNION ALL SELECT snapshot_id, code, name, 'top_industry_fund_flow', main_net, 50 FROM flow
 UNION ALL SELECT snapshot_id, code, name, 'top_concept_fund_flow', main_net, 80 FROM flow
 UNION ALL SELECT snapshot_id, code, name, 'top_stock_fund_flow', main_net, 100 FROM flow),
ranked_rows AS (SELECT *, row_number() OVER (PARTITION BY snapshot_id, list ORDER BY value DESC, code) AS rank FROM rows)"""


def frames(spark, sf):
    spot, board, flow = D.spot(spark, sf), D.boards(spark, sf), D.fund_flow(spark, sf)
    return {"stock": spot, "industry_board": board, "concept_board": board, "industry_flow": flow, "concept_flow": flow, "stock_flow": flow}


@query("k01_ranked_lists", C.with_ctes(C.SPOT, C.FLOW, C.BOARDS, RANKED_SQL, select="""
SELECT snapshot_id, list, rank, code, name, value FROM ranked_rows WHERE rank <= size"""))
def k01(spark, sf):
    return M.ranked_lists(frames(spark, sf))


@query("k01_ranked_lists_scoring", C.with_ctes(C.SPOT, C.FLOW, C.BOARDS, RANKED_SQL, select="""
SELECT snapshot_id, list, rank, code, name, value FROM ranked_rows
WHERE rank <= CASE list WHEN 'top_industries' THEN 30 WHEN 'top_concepts' THEN 50 WHEN 'top_industry_fund_flow' THEN 30
 WHEN 'top_concept_fund_flow' THEN 50 WHEN 'top_stock_fund_flow' THEN 80 ELSE size END"""))
def k01_scoring(spark, sf):
    return M.ranked_lists(frames(spark, sf), sizes=M.SCORING_LIST_SIZES)


@query("c02_snapshot_derivation", C.with_ctes(C.SPOT, C.POOLS, C.FLOW, C.BOARDS, SUMMARY, INDUSTRY, RANKED_SQL, select="""
SELECT s.snapshot_id, stock_count, tradeable_stock_count, limit_up_count, market_breadth, broken_limit_ratio,
 coalesce(n_ranked, 0) AS n_ranked, coalesce(top_gainer, '') AS top_gainer, coalesce(hottest_industry, '') AS hottest_industry
FROM summary s
LEFT JOIN (SELECT snapshot_id, count(*) AS n_ranked, max(code) FILTER (list = 'top_gainers' AND rank = 1) AS top_gainer
 FROM ranked_rows WHERE rank <= size GROUP BY 1) r USING (snapshot_id)
LEFT JOIN (SELECT snapshot_id, max(industry) FILTER (rank = 1) AS hottest_industry FROM ranked GROUP BY 1) i USING (snapshot_id)"""))
def c02(spark, sf):
    from tapeline.plans.snapshot import derive_overview

    return derive_overview(frames(spark, sf), D.pools(spark, sf))


@query("c20_market_pools", C.with_ctes(C.POOLS, select="""
SELECT snapshot_id, pool, code, name, industry, pct FROM pools WHERE session = (SELECT max(session) FROM pools)"""))
def c20(spark, sf):
    p = D.pools(spark, sf)
    newest = p.groupBy().agg(F.max("session"))
    return p.where(F.col("session") == newest.scalar()).select("snapshot_id", "pool", "code", "name", "industry", "pct")


@query("a22_counts", C.with_ctes(C.POOLS, select="""
SELECT pool, count(*) AS n_rows, count(DISTINCT code) AS n_codes, min(session) AS first_session, max(session) AS last_session
FROM pools GROUP BY 1"""))
def a22(spark, sf):
    return D.pools(spark, sf).groupBy("pool").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("code").alias("n_codes"),
        F.min("session").alias("first_session"), F.max("session").alias("last_session"),
    )


@query("s17_source_status", C.with_ctes(C.SPOT, C.POOLS, C.FLOW, C.BOARDS, select="""
, f AS (SELECT snapshot_id, 'stock_spot' AS frame, count(*) AS rows FROM spot GROUP BY 1
 UNION ALL SELECT snapshot_id, 'industry_boards', count(*) FROM boards GROUP BY 1
 UNION ALL SELECT snapshot_id, 'individual_fund_flow_today', count(*) FROM flow GROUP BY 1
 UNION ALL SELECT snapshot_id, pool || CASE WHEN pool = 'previous_limit_up' THEN '_pool' ELSE '_pool' END, count(*) FROM pools GROUP BY 1, 2),
w AS (SELECT snapshot_id, unnest(['stock_spot','industry_boards','concept_boards','individual_fund_flow_today','individual_fund_flow_5d',
 'industry_fund_flow_today','concept_fund_flow_today','limit_up_pool','previous_limit_up_pool','strong_pool','broken_limit_pool','dtgc_pool']) AS frame
 FROM (SELECT DISTINCT snapshot_id FROM f))
SELECT snapshot_id, frame, rows IS NOT NULL AS ok, coalesce(rows, 0) AS rows, CASE WHEN rows IS NULL THEN 'missing' END AS error
FROM w LEFT JOIN f USING (snapshot_id, frame)"""))
def s17(spark, sf):
    return M.source_status(frame_rows(spark, sf))


def frame_rows(spark, sf):
    one = lambda df, frame: df.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("frame", frame)
    pool = D.pools(spark, sf)
    rows = one(D.spot(spark, sf), F.lit("stock_spot")).unionByName(one(D.boards(spark, sf), F.lit("industry_boards")))
    rows = rows.unionByName(one(D.fund_flow(spark, sf), F.lit("individual_fund_flow_today")))
    per_pool = pool.groupBy("snapshot_id", F.concat("pool", F.lit("_pool")).alias("frame")).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.unionByName(per_pool).withColumn("error", F.lit(None).cast("string"))


@query("s16_vendor_fields", C.with_ctes(C.SPOT, select="""
SELECT snapshot_id, code, name, close, pct, volume, amount, amplitude, turnover, volume_ratio, high, low, open, prev_close FROM spot"""))
def s16(spark, sf):
    """Quotes written in vendor field codes as text, then decoded."""
    wanted = ["code", "name", "close", "pct", "volume", "amount", "amplitude", "turnover", "volume_ratio", "high", "low", "open", "prev_close"]
    s = D.spot(spark, sf)
    fields = constants.SPOT_FIELDS
    raw = s.select(
        "snapshot_id",
        *[(F.coalesce(F.col(c).cast("string"), F.lit("-")) if c in wanted else F.lit("-")).alias(f) for c, f in fields.items()],
    )
    return M.vendor_columns(raw, "spot", ["snapshot_id"], wanted)


SNAP_VALID = C.SNAPSHOTS + f", snaps AS (SELECT *, {C.WINDOW_VALID} AS window_valid FROM snapshots)"


def snaps(spark, sf):
    return D.snapshots(spark, sf).withColumn("window_valid", times.mode_window_valid("mode", "captured_at"))


@query("x28_mode_windows", C.with_ctes(SNAP_VALID, select="SELECT seq, mode, window_valid FROM snaps"))
def x28(spark, sf):
    return snaps(spark, sf).select("seq", "mode", "window_valid")


@query("x30_mode_from_clock", C.with_ctes(C.SNAPSHOTS, select="""
SELECT seq, CASE WHEN hour(captured_at) < 10 THEN 'morning' WHEN hour(captured_at) < 14 THEN 'midday' ELSE 'overnight' END AS mode FROM snapshots"""))
def x30(spark, sf):
    return D.snapshots(spark, sf).select("seq", times.mode_from_clock("captured_at").alias("mode"))


@query("x11_snapshot_ids", C.with_ctes(C.SNAPSHOTS, select="""
SELECT seq, strftime(captured_at, '%Y%m%dT%H%M%S') || '_' || mode || '_' || substr(sha256(mode || '|' || strftime(captured_at, '%Y-%m-%dT%H:%M:%S') || '+08:00'), 1, 10) AS id,
 market_date || '_historical_' || substr(sha256('daily|' || market_date || '|' || stock_count::varchar), 1, 16) AS historical_id FROM snapshots"""))
def x11(spark, sf):
    s = D.snapshots(spark, sf)
    return s.select(
        "seq", snapshot_id("mode", times.iso_text("captured_at")).alias("id"),
        historical_snapshot_id(F.lit("daily"), "market_date", F.col("stock_count").cast("string")).alias("historical_id"),
    )


@query("x18_compact_dates", C.with_ctes(C.SNAPSHOTS, select="""
SELECT seq, strptime(market_date, '%Y%m%d')::date AS day, market_date AS compact FROM snapshots"""))
def x18(spark, sf):
    s = D.snapshots(spark, sf).withColumn("day", times.compact_to_date("market_date"))
    return s.select("seq", "day", times.date_to_compact("day").alias("compact"))


@query("p11_snapshot_validity", C.with_ctes(SNAP_VALID, select="""
SELECT seq, spot_ok AND stock_count > 1000 AND tradeable_stock_count > 500 AND window_valid AS valid FROM snaps"""))
def p11(spark, sf):
    return snaps(spark, sf).select("seq", M.is_valid_snapshot().alias("valid"))


COMPLETE = """(stock_count >= {n} AND window_valid AND (mode = 'historical' OR
 hour(coalesce(source_time, captured_at)) * 60 + minute(coalesce(source_time, captured_at)) >= 895))"""


@query("p12_snapshot_completeness", C.with_ctes(SNAP_VALID, select=f"SELECT seq, {COMPLETE.format(n=4000)} AS complete FROM snaps"))
def p12(spark, sf):
    return snaps(spark, sf).select("seq", M.is_complete_snapshot(4000).alias("complete"))


@query("p20_snapshot_admission", C.with_ctes(C.SNAPSHOTS, select="SELECT seq, stock_count FROM snapshots WHERE stock_count >= 1000"))
def p20(spark, sf):
    return M.admitted(D.snapshots(spark, sf)).select("seq", "stock_count")


@query("p10_snapshot_listing", C.with_ctes(C.SNAPSHOTS, select="""
SELECT seq, mode, market_date FROM snapshots WHERE mode = 'overnight' AND market_date = (SELECT max(market_date) FROM snapshots WHERE mode = 'overnight')"""))
def p10(spark, sf):
    s = D.snapshots(spark, sf)
    newest = s.where(F.col("mode") == "overnight").groupBy().agg(F.max("market_date"))
    return M.snapshot_listing(s, mode="overnight").where(F.col("market_date") == newest.scalar()).select("seq", "mode", "market_date")


INDEX = f"""
ided AS (SELECT * REPLACE (coalesce(snapshot_id, 'legacy_' || substr(sha256(mode || '|' || strftime(captured_at, '%Y-%m-%d %H:%M:%S')), 1, 16)) AS snapshot_id)
 FROM snaps WHERE stock_count >= 1000),
idx AS (SELECT * EXCLUDE (rn), window_valid AS is_complete FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_id ORDER BY is_latest_file, seq) AS rn FROM ided) WHERE rn = 1)"""


@query("a20_snapshot_index", C.with_ctes(SNAP_VALID, INDEX, select="SELECT snapshot_id, mode, market_date, stock_count, path, is_complete FROM idx"))
def a20(spark, sf):
    return M.snapshot_index(snaps(spark, sf)).select("snapshot_id", "mode", "market_date", "stock_count", "path", "is_complete")


@query("p22_public_snapshot", C.with_ctes(SNAP_VALID, INDEX, select="SELECT * EXCLUDE (path, captured_at, source_time) FROM idx"))
def p22(spark, sf):
    return M.public_snapshot(M.snapshot_index(snaps(spark, sf))).drop("captured_at", "source_time")


@query("a19_latest_snapshots", C.with_ctes(SNAP_VALID, INDEX, select="""
SELECT 'mode' AS per, mode AS key, arg_max(snapshot_id, row(captured_at, snapshot_id)) AS snapshot_id FROM idx GROUP BY 2
UNION ALL SELECT 'day', market_date, arg_max(snapshot_id, row(captured_at, snapshot_id)) FROM idx GROUP BY 2"""))
def a19(spark, sf):
    index = M.snapshot_index(snaps(spark, sf))
    mode = M.latest_per_mode(index).select(F.lit("mode").alias("per"), F.col("mode").alias("key"), "snapshot_id")
    return mode.unionByName(M.latest_per_day(index).select(F.lit("day").alias("per"), F.col("market_date").alias("key"), "snapshot_id"))


@query("a23_complete_dates", C.with_ctes(SNAP_VALID, INDEX, select=f"""
SELECT DISTINCT strptime(market_date, '%Y%m%d')::date AS day, count(DISTINCT market_date) OVER () AS n_days FROM idx WHERE {COMPLETE.format(n=1000)}"""))
def a23(spark, sf):
    complete = M.snapshot_index(snaps(spark, sf)).where(M.is_complete_snapshot(1000))
    days = complete.select(times.compact_to_date("market_date").alias("day")).distinct()
    return days.withColumn("n_days", days.groupBy().count().scalar())


@query("c12_snapshot_choice", C.with_ctes(SNAP_VALID, INDEX, select="""
, m AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY captured_at DESC, snapshot_id DESC) AS rn FROM idx) WHERE rn = 1 AND mode <> 'historical')
SELECT * FROM (SELECT 'overnight' AS wanted, snapshot_id, mode FROM m WHERE mode IN ('overnight', 'custom')
 ORDER BY market_date DESC, coalesce(source_time::varchar, '') DESC, captured_at DESC, snapshot_id DESC LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'morning', snapshot_id, mode FROM m
 ORDER BY market_date DESC, coalesce(source_time::varchar, '') DESC, captured_at DESC, snapshot_id DESC LIMIT 1)"""))
def c12(spark, sf):
    index = M.snapshot_index(snaps(spark, sf))
    pick = lambda mode: M.choose_snapshot(index, mode).select(F.lit(mode).alias("wanted"), "snapshot_id", "mode")
    return pick("overnight").unionByName(pick("morning"))


@query("w25_last_snapshot_of_day", C.with_ctes(C.TICKS, select="""
SELECT code, market_date, arg_max(price, captured_at) AS price, max(captured_at) AS captured_at FROM ticks GROUP BY 1, 2"""))
def w25(spark, sf):
    from tapeline.operators.scaling import latest_by

    return latest_by(D.ticks(spark, sf).select("code", "market_date", "captured_at", "price"), ["code", "market_date"], "captured_at")


@query("p21_positive_observations", C.with_ctes(C.SPOT, select="SELECT snapshot_id, code, close FROM spot WHERE least(open, high, low, close) > 0"))
def p21(spark, sf):
    return M.numeric_observation(D.spot(spark, sf)).select("snapshot_id", "code", "close")


@query("j02_pool_and_flow_lookup", C.with_ctes(C.SPOT, C.POOLS, C.FLOW, select="""
, l AS (SELECT snapshot_id, code, pool, arg_max(turnover, seq) AS turnover, arg_max(industry, seq) AS industry FROM pools GROUP BY 1, 2, 3)
SELECT s.snapshot_id, s.code, f.main_net, a.industry AS previous_industry, b.turnover AS strong_turnover, c.turnover AS broken_turnover
FROM spot s LEFT JOIN flow f USING (snapshot_id, code)
LEFT JOIN l a ON a.snapshot_id = s.snapshot_id AND a.code = s.code AND a.pool = 'previous_limit_up'
LEFT JOIN l b ON b.snapshot_id = s.snapshot_id AND b.code = s.code AND b.pool = 'strong'
LEFT JOIN l c ON c.snapshot_id = s.snapshot_id AND c.code = s.code AND c.pool = 'broken_limit'"""))
def j02(spark, sf):
    out = M.with_pools_and_flow(D.spot(spark, sf).select("snapshot_id", "code"), D.fund_flow(spark, sf), D.pools(spark, sf))
    return out.select(
        "snapshot_id", "code", F.col("flow.main_net").alias("main_net"), F.col("previous_limit.industry").alias("previous_industry"),
        F.col("strong.turnover").alias("strong_turnover"), F.col("broken.turnover").alias("broken_turnover"),
    )
