"""Overnight candidate score queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.operators import market as M
from tapeline.operators import scoring as S
from tapeline.queries import ctes as C
from tapeline.queries.market import INDUSTRY, SUMMARY
from tapeline.queries.registry import query
from tapeline.sources import driver_tables as D

CAND = """last_pool AS (SELECT snapshot_id, code, pool, max(seq) AS seq FROM pools GROUP BY 1, 2, 3),
pr AS (SELECT p.* FROM pools p JOIN last_pool l USING (snapshot_id, code, pool, seq)),
c0 AS (SELECT s.snapshot_id, s.code, s.close AS price, coalesce(s.pct, 0.0) AS pct, s.amount, s.change_5m, s.high, s.low, f.main_net, f.main_net_pct,
  a.seq IS NOT NULL AS has_prev, b.seq IS NOT NULL AS has_strong, c.seq IS NOT NULL AS has_broken, coalesce(b.reason, '') AS strong_reason,
  coalesce(nullif(s.turnover, 0), nullif(b.turnover, 0), nullif(a.turnover, 0), c.turnover, 0.0) AS turnover,
  coalesce(nullif(s.volume_ratio, 0), b.volume_ratio, 0.0) AS vr,
  coalesce(nullif(s.speed, 0), nullif(b.speed, 0), nullif(a.speed, 0), c.speed, 0.0) AS speed,
  coalesce(nullif(coalesce(s.amplitude, 0.0), 0), nullif(a.amplitude, 0), c.amplitude, 0.0) AS amp,
  coalesce(nullif(a.industry, ''), nullif(b.industry, ''), nullif(c.industry, ''), '') AS industry
  FROM spot s LEFT JOIN flow f ON f.snapshot_id = s.snapshot_id AND f.code = s.code
  LEFT JOIN pr a ON a.snapshot_id = s.snapshot_id AND a.code = s.code AND a.pool = 'previous_limit_up'
  LEFT JOIN pr b ON b.snapshot_id = s.snapshot_id AND b.code = s.code AND b.pool = 'strong'
  LEFT JOIN pr c ON c.snapshot_id = s.snapshot_id AND c.code = s.code AND c.pool = 'broken_limit'),
c1 AS (SELECT c0.*, CASE WHEN high > low THEN (price - low) / (high - low) ELSE 0.0 END AS cp, coalesce(main_net, 0.0) AS net, coalesce(main_net_pct, 0.0) AS npct,
  m.market_breadth AS breadth, m.broken_limit_ratio AS blr, i.limit_up_count AS hl, i.strong_count AS hs, i.previous_limit_count AS hp,
  (i.limit_up_count * 2 + i.strong_count)::double AS hscore, i.limit_up_count >= 5 AND i.strong_count >= 8 AND i.previous_limit_count >= 4 AS hot
  FROM c0 LEFT JOIN summary m USING (snapshot_id) LEFT JOIN ind i ON i.snapshot_id = c0.snapshot_id AND i.industry = c0.industry)"""
SCORE = """c2 AS (SELECT *, pct BETWEEN 1 AND 7.5 AS core, pct > 7.5 AND pct <= 9.3 AS top, pct >= -1.5 AND pct < 1 AS lowp,
  least(vr, 6) * 3.0::double AS vol, least(speed, 3) * 4.0::double AS up, least(change_5m, 4) * 3.0::double AS up5, least(net / 100000000, 8) * 3.0::double AS inflow,
  least(coalesce(hscore, 0.0), 18) AS warm FROM c1),
c3 AS (SELECT *,
  CASE WHEN core THEN pct * 4.0::double WHEN top THEN 18 WHEN lowp THEN 6 ELSE 0 END + least(amount / 1000000000, 8) * 2.2::double + least(turnover, 18) * 0.75::double
  + CASE WHEN vr >= 1 THEN vol ELSE 0 END + CASE WHEN speed > 0 THEN up ELSE 0 END + CASE WHEN change_5m > 0 THEN up5 ELSE 0 END
  + CASE WHEN net > 0 THEN inflow ELSE 0 END + CASE WHEN npct > 3 THEN least(npct, 12) ELSE 0 END + CASE WHEN has_prev THEN 8 ELSE 0 END
  + CASE WHEN has_strong THEN 7 ELSE 0 END - CASE WHEN has_broken THEN 16 ELSE 0 END + CASE WHEN warm > 0 THEN warm ELSE 0 END - CASE WHEN amount < 100000000 THEN 10 ELSE 0 END AS s,
  CASE WHEN core THEN least(pct * 4.0::double, 24) WHEN top THEN 10 WHEN lowp THEN 5 ELSE 0 END + least(amount / 1000000000, 6) * 1.5::double
  + CASE WHEN turnover BETWEEN 2 AND 15 THEN 8 ELSE 0 END + CASE WHEN vr >= 1 THEN least(vol, 12) ELSE 0 END + CASE WHEN speed > 0 THEN up ELSE 0 END
  + CASE WHEN change_5m > 0 THEN up5 ELSE 0 END + CASE WHEN cp >= 0.75 THEN 6 ELSE 0 END + CASE WHEN amp BETWEEN 3 AND 10 THEN 4 ELSE 0 END
  + CASE WHEN net > 0 THEN least(inflow, 18) ELSE 0 END + CASE WHEN npct > 3 THEN least(npct, 10) ELSE 0 END + CASE WHEN has_prev THEN 10 ELSE 0 END
  + CASE WHEN has_strong THEN 7 ELSE 0 END - CASE WHEN has_broken THEN 12 ELSE 0 END + CASE WHEN warm > 0 THEN least(warm * 0.6::double, 10) ELSE 0 END
  - CASE WHEN pct >= 8.8 THEN 8 ELSE 0 END - CASE WHEN breadth <> 0 AND breadth < 0.25 THEN 10 WHEN breadth <> 0 AND breadth < 0.35 THEN 7 ELSE 0 END AS a,
  CASE WHEN core AND pct <= 6.5 THEN 8 WHEN core THEN 2 WHEN top THEN -8 WHEN lowp THEN 4 ELSE -8 END + CASE WHEN turnover BETWEEN 2 AND 15 THEN 7 WHEN turnover > 20 THEN -8 ELSE 0 END
  + CASE WHEN vr >= 1 THEN least(vol, 8) ELSE 0 END + CASE WHEN speed > 0 THEN least(up, 10) WHEN speed < -1 THEN -6 ELSE 0 END
  + CASE WHEN change_5m > 0 THEN least(up5, 8) WHEN change_5m < -1 THEN -6 ELSE 0 END + CASE WHEN cp >= 0.75 THEN 10 WHEN cp > 0 AND cp < 0.55 THEN -10 ELSE 0 END
  - CASE WHEN amp > 12 THEN 6 ELSE 0 END + CASE WHEN net > 0 THEN least(inflow, 16) WHEN net < -100000000 THEN -10 ELSE 0 END + CASE WHEN npct > 3 THEN least(npct, 8) ELSE 0 END
  + CASE WHEN has_prev THEN 9 ELSE 0 END + CASE WHEN has_strong THEN 7 ELSE 0 END - CASE WHEN has_broken THEN 16 ELSE 0 END
  + CASE WHEN warm > 0 THEN least(warm * 0.5::double, 9) ELSE 0 END - CASE WHEN hot THEN 10 ELSE 0 END - CASE WHEN pct >= 8.8 THEN 12 ELSE 0 END
  - CASE WHEN amount < 100000000 THEN 10 ELSE 0 END - CASE WHEN breadth <> 0 AND breadth < 0.25 THEN 20 WHEN breadth <> 0 AND breadth < 0.35 THEN 14 ELSE 0 END
  - CASE WHEN blr > 0.30 THEN 8 ELSE 0 END AS h,
  (net > 0)::int + has_prev::int + has_strong::int + (warm > 0)::int AS n_sources,
  CASE WHEN hl IS NULL THEN 'medium' WHEN hot THEN 'high' WHEN hl >= 3 THEN 'medium' ELSE 'low' END AS rotation_risk FROM c2),
c4 AS (SELECT *, round(greatest(s, 0), 2) AS market_score, round(greatest(least(a, 100), 0), 2) AS next_day_accept_score,
  round(greatest(least(h + least(greatest(a, 0), 70) * 0.45::double - CASE WHEN n_sources = 0 THEN 8 ELSE 0 END, 100), 0), 2) AS high_open_score FROM c3),
scored AS (SELECT *, CASE WHEN high_open_score >= 70 AND next_day_accept_score >= 60 AND rotation_risk <> 'high' THEN 'priority'
  WHEN high_open_score >= 55 AND next_day_accept_score >= 50 THEN 'watch' ELSE 'avoid' END AS execution_grade FROM c4)"""


def candidates(spark, sf):
    pools = D.pools(spark, sf)
    spot = D.spot(spark, sf)
    stocks = M.compact_stocks(spot, ["snapshot_id"])
    df = M.with_pools_and_flow(stocks, D.fund_flow(spark, sf), pools).withColumn("industry", S.candidate_industry())
    heat = M.pool_industry_counts(pools).withColumn("score", (F.col("limit_up_count") * 2 + F.col("strong_count")).cast("double"))
    context = M.market_summary(spot, pools).select("snapshot_id", "market_breadth", "broken_limit_ratio")
    return S.with_industry_heat(df, heat).join(context, "snapshot_id", "left")


@query("j11_industry_heat", C.with_ctes(C.SPOT, C.POOLS, C.FLOW, SUMMARY, INDUSTRY, CAND, select="SELECT snapshot_id, code, industry, hl AS limit_up_count, hscore AS score FROM c1"))
def j11(spark, sf):
    return candidates(spark, sf).select("snapshot_id", "code", "industry", "heat.limit_up_count", "heat.score")


@query("c03_overnight_scores", C.with_ctes(C.SPOT, C.POOLS, C.FLOW, SUMMARY, INDUSTRY, CAND, SCORE, select="""
SELECT snapshot_id, code, industry, market_score, next_day_accept_score, high_open_score, execution_grade, rotation_risk, n_sources,
 high_open_score < 70 OR rotation_risk = 'high' AS requires_news_catalyst, round(cp, 4) AS close_position FROM scored"""))
def c03(spark, sf):
    out = S.score_candidates(candidates(spark, sf))
    return out.select(
        "snapshot_id", "code", "industry", "market_score", "next_day_accept_score", "high_open_score", "execution_grade", "rotation_risk",
        F.size("next_day_fund_sources").alias("n_sources"), "requires_news_catalyst", "close_position",
    )
