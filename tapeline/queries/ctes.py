"""Adapters restated in DuckDB SQL, as common table expressions that check queries build on."""

CODE = (
    "(list_extract(['000','600','300','002','688','601','003','920','603','001'], ({k} % 10 + 1)::int)"
    " || CASE WHEN length(({k})::varchar) < 3 THEN lpad(({k})::varchar, 3, '0') ELSE ({k})::varchar END)"
)


def code(k: str) -> str:
    return CODE.format(k=k)


NAMES = "names AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 23 = 0 THEN 'ST' ELSE '' END || s_name AS name FROM supplier)"

AT = "row(l_shipdate, l_orderkey, l_linenumber, l_partkey)"

BARS = f"""{NAMES},
bars0 AS (
  SELECT l_suppkey AS k, date_trunc('month', l_shipdate)::date AS session,
         arg_min(l_extendedprice, {AT}) AS o, arg_max(l_extendedprice, {AT}) AS c,
         max(l_extendedprice) AS h, min(l_extendedprice) AS l, sum(l_quantity) AS q,
         sum(l_extendedprice::decimal(18,2))::double AS a, sum(l_discount::decimal(18,2))::double AS d,
         sum(l_tax::decimal(18,2))::double AS t,
         count(*) FILTER (l_returnflag = 'R') AS nr, count(*) FILTER (l_returnflag = 'A') AS na,
         count(*) FILTER (l_linestatus = 'F') AS nf, count(*) FILTER (l_linestatus = 'O') AS no
  FROM lineitem GROUP BY 1, 2),
bars1 AS (
  SELECT b.k, {code('b.k')} AS code, coalesce(n.name, '') AS name, session,
         ((year(session) - 1990) * 12 + month(session))::int AS session_no,
         50.0::double + o / 20011.0::double AS open, 50.0::double + h / 20011.0::double AS high,
         50.0::double + l / 20011.0::double AS low, 50.0::double + c / 20011.0::double AS close,
         q * 100.0::double AS volume, a * 1000.0::double AS amount, d * 10.0::double AS turnover, t * 5.0::double AS volume_ratio,
         (nr - na)::double AS speed, (nf - no)::double AS change_5m
  FROM bars0 b LEFT JOIN names n ON n.k = b.k),
bars2 AS (SELECT *, lag(close) OVER (PARTITION BY code ORDER BY session) AS prev_close FROM bars1),
bars AS (SELECT *, (close / prev_close - 1.0::double) * 100.0::double AS pct,
                (high - low) / prev_close * 100.0::double AS amplitude FROM bars2)"""

SNAP = "'snap-' || strftime({s}, '%Y%m%d')"

SPOT = BARS + f""",
spot AS (SELECT {SNAP.format(s='session')} AS snapshot_id, *, amount * 50.0::double AS float_cap,
                amount * 80.0::double AS total_cap FROM bars)"""

POOLS = f"""pools AS (
  SELECT {SNAP.format(s="date_trunc('month', o_orderdate)")} AS snapshot_id,
         date_trunc('month', o_orderdate)::date AS session,
         list_extract(['limit_up','previous_limit_up','strong','broken_limit'], (o_orderkey % 4 + 1)::int) AS pool,
         {code('(o_custkey // 15)')} AS code, 'Pool#' || (o_custkey // 15)::varchar AS name,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS industry,
         (o_orderkey % 21 - 10)::double AS pct, (o_orderkey % 19)::double AS turnover,
         (o_orderkey % 7 - 3)::double AS speed, (o_orderkey % 14)::double AS amplitude,
         (o_orderkey % 5)::double AS volume_ratio,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE '' END AS reason, o_orderkey AS seq
  FROM orders)"""

FLOW = f"""flow0 AS (
  SELECT l_suppkey AS k, date_trunc('month', l_shipdate)::date AS session,
         sum((CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END)::decimal(18,2))::double AS net,
         sum(l_extendedprice::decimal(18,2))::double AS gross,
         sum((CASE WHEN l_quantity >= 40 THEN CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END ELSE 0 END)::decimal(18,2))::double AS sup,
         sum((CASE WHEN l_quantity BETWEEN 20 AND 39 THEN CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END ELSE 0 END)::decimal(18,2))::double AS big
  FROM lineitem GROUP BY 1, 2),
flow AS (
  SELECT {SNAP.format(s='session')} AS snapshot_id, {code('f.k')} AS code, coalesce(n.name, '') AS name,
         net / gross * 10.0::double AS pct, net * 1000.0::double AS main_net, net / gross * 15.0::double AS main_net_pct,
         sup * 1000.0::double AS super_net, big * 1000.0::double AS big_net
  FROM flow0 f LEFT JOIN names n ON n.k = f.k)"""

BOARDS = f"""boards0 AS (
  SELECT date_trunc('month', l_shipdate)::date AS session, p_brand AS board,
         sum(l_extendedprice::decimal(18,2))::double AS amount, sum(l_discount::decimal(18,2))::double AS d, count(*) AS n,
         count(*) FILTER (l_returnflag = 'N') AS rise_count, count(*) FILTER (l_returnflag = 'R') AS fall_count,
         arg_max(l_suppkey, row(l_extendedprice, l_suppkey)) AS lead, max(l_extendedprice) AS lead_px
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
boards AS (
  SELECT {SNAP.format(s='session')} AS snapshot_id, replace(board, 'Brand#', 'BK') AS code, board AS name,
         (rise_count - fall_count)::double / n * 10.0::double AS pct, amount, d / n AS turnover,
         rise_count::double AS rise_count, fall_count::double AS fall_count,
         {code('lead')} AS leader, lead_px / 10000.0::double AS leader_pct FROM boards0)"""

NEWS = f"""{NAMES},
news0 AS (
  SELECT doc_id, list_extract(['cls','eastmoney_global','cninfo','ndrc'], (regexp_extract(source, '(\\d+)$', 1)::int % 4 + 1)::int) AS source,
         source AS channel, lang, text AS content, coalesce(n.name, '') AS stock_name, {code('(doc_id % 100)')} AS code6,
         'doc://' || md5(text) AS url, timestamp '2024-01-01' + to_minutes(37 * doc_id) AS wall,
         regexp_extract(text, '^[^.\\n]+') AS head
  FROM documents LEFT JOIN names n ON n.k = doc_id % 100),
news1 AS (
  SELECT *, ((doc_id % 5 = 3) OR (doc_id % 5 = 0 AND (source = 'cls' OR (source = 'cninfo' AND strftime(wall, '%H:%M:%S') = '16:00:00')))) AS utc
  FROM news0),
news AS (
  SELECT doc_id, source, channel, lang,
         CASE WHEN doc_id % 3 = 0 AND stock_name <> '' THEN stock_name || ': ' ELSE '' END || head AS title,
         content, '' AS summary, url,
         CASE doc_id % 5 WHEN 0 THEN strftime(wall, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(wall, '%Y-%m-%d %H:%M:%S')
              WHEN 2 THEN strftime(wall, '%Y/%m/%d %H:%M:%S') WHEN 3 THEN strftime(wall, '%Y-%m-%dT%H:%M:%S+00:00')
              ELSE strftime(wall, '%Y-%m-%d %H:%M') END AS publish_time,
         CASE WHEN utc THEN wall + interval 8 hour ELSE wall END AS bj,
         CASE WHEN utc THEN wall + interval 8 hour ELSE wall END + to_minutes((7 * doc_id) % 300 - 5) AS collected,
         strftime(CASE WHEN utc THEN wall + interval 8 hour ELSE wall END + to_minutes((7 * doc_id) % 300 - 5), '%Y-%m-%dT%H:%M:%S') || '+08:00' AS crawled_at,
         CASE WHEN doc_id % 7 = 0 THEN ltrim(code6, '0') ELSE code6 END AS stock_code, stock_name,
         CASE WHEN source = 'cninfo' THEN lang ELSE '' END AS announcement_type
  FROM news1)"""

MESSAGES = NEWS + """,
messages AS (
  SELECT doc_id, source, title, stock_code, CASE WHEN source = 'cninfo' THEN 'announcement' ELSE 'news' END AS kind,
         timestamp '1995-01-01 15:00:00' + to_months((doc_id % 60)::int) - to_minutes(((doc_id * 11) % 130) * 60) AS stamp
  FROM news)"""

TICKS = """ticks AS (
  SELECT user_id::varchar AS code, ts::date AS market_date, ts AS captured_at, value AS price,
         (sum(value::decimal(18,2)) OVER (PARTITION BY user_id, ts::date ORDER BY ts ROWS UNBOUNDED PRECEDING))::double AS amount
  FROM events)"""

TRADES = f"""trades AS (
  SELECT l_suppkey % 10 AS account, lpad((l_partkey % 200)::varchar, 6, '0') AS code, 'Part#' || (l_partkey % 200)::varchar AS name,
         {AT} AS seq, CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS side, l_quantity::bigint AS quantity,
         l_extendedprice / l_quantity AS price, l_shipdate AS at FROM lineitem)"""

RUN_LOG = """run_log AS (
  SELECT 'source' || (user_id % 10)::varchar AS source, ts, event_type NOT IN ('error', 'view') AS ok,
         CASE WHEN event_type IN ('error', 'view') THEN event_type || ' ' || props END AS error, 60 AS base_interval,
         floor(value)::bigint AS fetched, floor(value / 2)::bigint AS saved, floor(value / 4)::bigint AS duplicates,
         floor(value / 8)::bigint AS filtered, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END::bigint AS errors FROM events)"""

RUNS = """runs AS (
  SELECT o_orderdate::date AS trade_date, CASE WHEN o_orderkey % 2 = 0 THEN 'morning' ELSE 'overnight' END AS mode,
         o_orderkey AS recorded_at, 'run-' || o_orderkey::varchar AS run_id, o_custkey AS author, o_totalprice AS size,
         o_orderpriority AS judgment FROM orders)"""


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select

SNAPSHOTS = """snapshots AS (
  SELECT CASE WHEN o_orderkey % 11 <> 0 THEN 'S' || (o_orderkey // 2)::varchar END AS snapshot_id,
         list_extract(['morning','midday','overnight','custom','historical'], ((o_orderkey // 2) % 5 + 1)::int) AS mode,
         o_orderdate + to_minutes((o_orderkey * 17) % 1440) AS captured_at,
         CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + to_minutes((o_orderkey * 17) % 1440) END AS source_time,
         strftime(o_orderdate, '%Y%m%d') AS market_date, o_orderstatus <> 'P' AS spot_ok,
         floor(o_totalprice / 50)::bigint AS stock_count, floor(floor(o_totalprice / 50) * 0.55::double)::bigint AS tradeable_stock_count,
         o_orderkey % 2 = 1 AS is_latest_file, 'file-' || o_orderkey::varchar AS path, o_orderkey AS seq FROM orders)"""
MINUTE = "(hour({t}) * 60 + minute({t}))"
WINDOW_VALID = (
    "CASE mode WHEN 'morning' THEN " + MINUTE + " BETWEEN 554 AND 586 WHEN 'midday' THEN " + MINUTE
    + " BETWEEN 587 AND 868 WHEN 'overnight' THEN " + MINUTE + " BETWEEN 869 AND 902 ELSE true END"
).format(t="captured_at")
