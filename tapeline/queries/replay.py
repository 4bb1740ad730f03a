"""Point-in-time replay queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions import codes
from tapeline.operators import asof, channels
from tapeline.plans import replay as P
from tapeline.queries import ctes as C
from tapeline.queries.features import REPLAY
from tapeline.queries.registry import query
from tapeline.session import staged
from tapeline.sources import driver_tables as D

# The driver's text is not Chinese, so the title flags use frequent words of its own languages.
POSITIVE = ("tion", "der", "que")
RISK = ("wh", "sch", "zz")


def any_sql(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")::int"


PANEL = REPLAY + """,
top AS (SELECT max(session_no) AS top_no FROM bars),
sessions AS (SELECT DISTINCT session, session_no FROM bars),
panel0 AS (SELECT rf.*, s.session_no AS as_of_no FROM rf, top, sessions s
  WHERE is_tradable AND s.session_no BETWEEN rf.session_no AND coalesce(next_no - 1, top_no)),
panel AS (SELECT *,
  CASE WHEN ret5 IS NOT NULL THEN cume_dist() OVER (PARTITION BY as_of_no, ret5 IS NULL ORDER BY ret5) END AS ret5_pct_rank,
  cume_dist() OVER (PARTITION BY as_of_no ORDER BY liquidity_proxy) AS liquidity_proxy_pct_rank,
  CASE WHEN atr5 IS NOT NULL THEN 1.0 - cume_dist() OVER (PARTITION BY as_of_no, atr5 IS NULL ORDER BY atr5) END AS atr5_pct_rank FROM panel0),
decisions AS (SELECT session AS decision_date, session_no AS decision_no, mode, session_no - back AS as_of_no,
  session + clock AS cutoff, session + clock - interval 4 day AS lower
  FROM sessions, (VALUES ('morning', interval '09:25:00', 1), ('overnight', interval '15:00:00', 0)) m(mode, clock, back)
  WHERE session_no - back >= (SELECT min(session_no) FROM sessions))"""

NORM = "replace(regexp_replace({c}, '[\\s*ＡA]', '', 'g'), 'ST', '')"
EVENTS = C.MESSAGES.replace(C.NAMES + ",", "") + f""",
ann AS (SELECT d.mode, d.decision_no, lpad(m.stock_code, 6, '0') AS code, count(*) AS ann_count,
  sum({any_sql('m.title', POSITIVE)})::bigint AS positive_ann, sum({any_sql('m.title', RISK)})::bigint AS risk_ann
  FROM messages m JOIN decisions d ON m.stamp BETWEEN d.lower AND d.cutoff WHERE m.kind = 'announcement' GROUP BY 1, 2, 3),
mention_pairs AS (SELECT m.doc_id, m.stamp, n.code, n.norm, {NORM.format(c='m.title')} AS t
  FROM messages m JOIN (SELECT DISTINCT code, {NORM.format(c='name')} AS norm FROM bars) n
  ON length(n.norm) >= 3 AND contains({NORM.format(c='m.title')}, n.norm) WHERE m.kind = 'news'),
mentions AS (SELECT d.mode, d.decision_no, p.code, p.norm, count(*) AS news_mentions,
  sum({any_sql('p.t', POSITIVE)})::bigint AS positive_news, sum({any_sql('p.t', RISK)})::bigint AS risk_news
  FROM mention_pairs p JOIN decisions d ON p.stamp BETWEEN d.lower AND d.cutoff GROUP BY 1, 2, 3, 4),
feat AS (SELECT p.*, d.mode, d.decision_no, d.decision_date, coalesce(ann_count, 0) AS ann_count, coalesce(news_mentions, 0) AS news_mentions,
  coalesce(risk_ann, 0) + coalesce(risk_news, 0) AS risk_hits, coalesce(positive_ann, 0) + coalesce(positive_news, 0) AS positive_hits
  FROM panel p JOIN decisions d USING (as_of_no)
  LEFT JOIN ann a ON a.mode = d.mode AND a.decision_no = d.decision_no AND a.code = p.code
  LEFT JOIN mentions m ON m.mode = d.mode AND m.decision_no = d.decision_no AND m.code = p.code AND m.norm = {NORM.format(c='p.name')})"""

R, L, A = "ret5_pct_rank", "liquidity_proxy_pct_rank", "atr5_pct_rank"
CHANNEL_SQL = {
    "T01": (f"close > ma5 AND ma5 > ma10 * 0.995::double AND ret5 BETWEEN 1 AND 9 AND (ret10 IS NULL OR ret10 BETWEEN -1 AND 16) AND range_position10 BETWEEN 0.42 AND 0.86 AND volume_ratio5 BETWEEN 0.72 AND 1.8 AND close_position >= 0.55 AND upper_shadow <= 0.045 AND pct BETWEEN -0.8 AND 4.5",
            f"30 * ret5 / 9 + 18 * close_position + 18 * {R} + 12 * {L} - 100 * upper_shadow"),
    "T02": ("close >= ma10 * 0.99::double AND (ret10 IS NULL OR ret10 >= 1.5) AND drawdown_high10 BETWEEN -9 AND -0.8 AND pct BETWEEN -2.8 AND 1.3 AND volume_ratio5 BETWEEN 0.35 AND 0.98 AND close_position >= 0.48 AND lower_shadow >= upper_shadow * 0.7::double",
            f"30 * (1 - volume_ratio5) + 20 * close_position + 15 * (drawdown_high10 + 9) / 8.2::double + 15 * {L}"),
    "T03": ("close / prior_high10 BETWEEN 0.975 AND 1.035 AND pct BETWEEN 0.4 AND 5 AND volume_ratio5 BETWEEN 1.08 AND 2.4 AND ret5 BETWEEN 1 AND 11 AND upper_shadow <= 0.035 AND close_position >= 0.68",
            f"35 * least(close / prior_high10, 1.02::double) + 20 * close_position + 15 * least(volume_ratio5, 1.8::double) + 15 * {R} - 100 * upper_shadow"),
    "T04": ("ret10 BETWEEN 4 AND 20 AND pullback_days3 >= 1 AND pct BETWEEN -1.2 AND 2.8 AND close >= ma5 * 0.985::double AND range_position10 BETWEEN 0.52 AND 0.9 AND volume_ratio5 BETWEEN 0.5 AND 1.55 AND drawdown_high10 BETWEEN -8 AND -0.5",
            f"25 * {R} + 20 * close_position + 20 * (pullback_days3 / 3) + 15 * {L} + ret10"),
    "T05": ("compression BETWEEN 0.25 AND 0.82 AND close >= ma10 * 0.99::double AND range_position10 BETWEEN 0.3 AND 0.76 AND drawdown_high10 BETWEEN -16 AND -2 AND pct BETWEEN -1.3 AND 2.6 AND volume_ratio5 BETWEEN 0.5 AND 1.45 AND atr5 BETWEEN 0.5 AND 7",
            f"35 * (1 - compression) + 20 * close_position + 15 * (1 - range_position10) + 15 * {L}"),
    "T06": (f"{R} >= 0.76 AND {L} >= 0.62 AND {A} >= 0.45 AND pct BETWEEN -1 AND 4.8 AND (ret10 IS NULL OR ret10 <= 20) AND range_position10 <= 0.92 AND close_position >= 0.52",
            f"35 * {R} + 30 * {L} + 20 * {A} + 15 * close_position"),
    "T07": ("positive_hits >= 1 AND close >= ma5 * 0.98::double AND ret5 BETWEEN -3 AND 11 AND pct BETWEEN -2.2 AND 4.8 AND volume_ratio5 BETWEEN 0.45 AND 2.1",
            f"38 * least(positive_hits, 3) + 12 * ann_count + 20 * close_position + 15 * {L}"),
    "T08": ("news_mentions >= 1 AND range_position10 <= 0.7 AND close >= ma10 * 0.975::double AND (ret10 IS NULL OR ret10 BETWEEN -5 AND 13) AND pct BETWEEN -2.2 AND 3.2 AND volume_ratio5 BETWEEN 0.45 AND 1.6",
            f"35 * least(news_mentions, 4) + 18 * (1 - range_position10) + 15 * close_position + 15 * {L}"),
    "T09": ("ret10 BETWEEN -16 AND 2.5 AND range_position10 BETWEEN 0.08 AND 0.58 AND (cross_ma3 OR close > ma3) AND pct BETWEEN 0.15 AND 4.2 AND close_position >= 0.62 AND volume_ratio5 BETWEEN 0.72 AND 2.2 AND lower_shadow >= 0.002",
            f"30 * close_position + 20 * (1 - range_position10) + 18 * least(volume_ratio5, 1.6::double) + 15 * {L}"),
    "T10": ("close >= ma10 * 0.98::double AND ret5 BETWEEN -1.5 AND 9 AND pct BETWEEN -1.3 AND 4.2 AND range_position10 BETWEEN 0.22 AND 0.82 AND volume_ratio5 BETWEEN 0.58 AND 1.75 AND atr5 BETWEEN 0.4 AND 8",
            f"20 * {R} + 18 * {L} + 18 * {A} + 16 * close_position + 12 * (1 - abs(volume_ratio5 - 1.05::double)) + least(positive_hits, 2) * 8 + least(news_mentions, 2) * 4 - (greatest(ret5 - 6, 0) * 2 + greatest(range_position10 - 0.72::double, 0) * 30)"),
}
GATE = f"ma5 <> 0 AND ma10 <> 0 AND ret5 IS NOT NULL AND volume_ratio5 IS NOT NULL AND {L} >= 0.18 AND risk_hits = 0 AND pct < CASE WHEN mode = 'overnight' THEN 5.5 ELSE 7.5 END AND big_gain_days3 <= 1"
SCORES = "scores AS (" + " UNION ALL ".join(
    f"SELECT *, '{ch}' AS channel, ({score})::double AS raw_score FROM feat WHERE {GATE} AND {cond}" for ch, (cond, score) in CHANNEL_SQL.items()
) + """),
picks AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mode, decision_no, channel ORDER BY raw_score DESC, liquidity_proxy DESC, code) AS rank FROM scores) WHERE rank <= 3),
votes AS (SELECT mode, decision_no, code, sum(4 - rank)::bigint AS votes, string_agg(channel, ',' ORDER BY channel) AS channels, count(*) AS nc FROM picks GROUP BY 1, 2, 3),
agreed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mode, decision_no ORDER BY votes DESC, nc DESC, code DESC) AS rank FROM votes) WHERE rank <= 5),
chosen AS (SELECT mode, decision_no, code, channel AS grp FROM picks WHERE rank = 1
  UNION ALL SELECT mode, decision_no, code, 'CONSENSUS_R' || rank FROM agreed WHERE rank <= 2),
o0 AS (SELECT c.*, CASE WHEN c.mode = 'morning' THEN e.open ELSE e.close END AS entry, x.session AS nd, x.open AS no, x.high AS nh, x.low AS nl, x.close AS nc,
  c.decision_no >= top_no AS is_last FROM chosen c CROSS JOIN top LEFT JOIN bars e ON e.code = c.code AND e.session_no = c.decision_no
  LEFT JOIN bars x ON x.code = c.code AND x.session_no = c.decision_no + 1),
outcomes AS (SELECT mode, decision_no, code, grp, CASE WHEN is_last THEN 'pending' WHEN entry IS NULL OR nd IS NULL THEN 'missing' ELSE 'complete' END AS status,
  round((no / entry - 1.0) * 100.0, 4) AS next_open_return, round((nh / entry - 1.0) * 100.0, 4) AS next_high_return,
  round((nl / entry - 1.0) * 100.0, 4) AS next_low_return, round((nc / entry - 1.0) * 100.0, 4) AS next_close_return,
  (nh / entry - 1.0) * 100.0 >= 0.5 AS red_window, (no / entry - 1.0) * 100.0 > 0 AS positive_open, (nc / entry - 1.0) * 100.0 > 0 AS positive_close,
  (nh / entry - 1.0) * 100.0 <= 0 AS no_red FROM o0),
summary AS (SELECT mode, grp AS "group", count(*) AS samples, avg(red_window::int) * 100 AS red_window_rate, avg(positive_open::int) * 100 AS positive_open_rate,
  avg(positive_close::int) * 100 AS positive_close_rate, avg(no_red::int) * 100 AS no_red_rate, avg(next_open_return) AS mean_open_return,
  median(next_high_return) AS median_high_return, avg(next_high_return) AS mean_high_return, median(next_close_return) AS median_close_return,
  avg(next_close_return) AS mean_close_return, min(next_low_return) AS worst_low_return FROM outcomes WHERE status = 'complete' GROUP BY 1, 2)"""


def signals(spark, sf) -> P.Signals:
    """Signals over stored bars: the monthly bars stand for a table a user has on disk."""
    return replay(spark, sf)[0]


def replay(spark, sf) -> tuple[P.Signals, DataFrame]:
    bars = staged(D.bars(spark, sf), "bars")
    return P.generate_signals(bars, D.messages(spark, sf), positive=POSITIVE, risk=RISK, stage=staged), bars


def outcomes(spark, sf):
    s, bars = replay(spark, sf)
    picks = staged(s.picks, "picks")
    return P.evaluate(picks, channels.consensus(picks), bars)


@query("j03_as_of_panel", C.with_ctes(PANEL, select="SELECT as_of_no, code, session, round(close, 4) AS close FROM panel0"))
def j03(spark, sf):
    from tapeline.operators.features import replay_features

    b = D.bars(spark, sf)
    last = b.groupBy().agg(F.max("session_no"))
    panel = asof.as_of_panel(replay_features(b), last.scalar()).where("is_tradable")
    return panel.select("as_of_no", "code", "session", F.round("close", 4).alias("close"))


@query("w16_percentile_ranks", C.with_ctes(PANEL, select=f"SELECT as_of_no, code, round({R}, 6) AS {R}, round({L}, 6) AS {L}, round({A}, 6) AS {A} FROM panel"))
def w16(spark, sf):
    return P.ranked_panel(D.bars(spark, sf), staged).select("as_of_no", "code", *[F.round(c, 6).alias(c) for c in (R, L, A)])


@query("j05_visible_messages", C.with_ctes(PANEL, C.MESSAGES.replace(C.NAMES + ",", ""), select="""
SELECT d.mode, d.decision_no, m.kind, m.doc_id FROM messages m JOIN decisions d ON m.stamp BETWEEN d.lower AND d.cutoff"""))
def j05(spark, sf):
    d = asof.decisions(P.market_sessions(D.bars(spark, sf)))
    return asof.visible_messages(D.messages(spark, sf), d).select("mode", "decision_no", "kind", "doc_id")


@query("p14_message_visibility", C.with_ctes(PANEL, C.MESSAGES.replace(C.NAMES + ",", ""), select="""
SELECT d.mode, d.decision_no, count(*) AS n_visible, strftime(max(m.stamp), '%Y-%m-%d %H:%M:%S') AS newest
FROM messages m JOIN decisions d ON m.stamp BETWEEN d.lower AND d.cutoff GROUP BY 1, 2"""))
def p14(spark, sf):
    d = asof.decisions(P.market_sessions(D.bars(spark, sf)))
    seen = asof.visible_messages(D.messages(spark, sf), d).groupBy("mode", "decision_no")
    return seen.agg(F.count(F.lit(1)).alias("n_visible"), F.substring(F.max("stamp").cast("string"), 1, 19).alias("newest"))


@query("x15_normalized_names", C.with_ctes(C.NAMES, select=f"SELECT k, {NORM.format(c='name')} AS norm_name FROM names"))
def x15(spark, sf):
    return D.names(spark, sf).select("k", codes.normalized_name("name").alias("norm_name"))


@query("j06_name_mentions", C.with_ctes(C.NEWS, select=f"""
SELECT doc_id, {C.code('n.k')} AS code FROM news JOIN names n ON length({NORM.format(c='n.name')}) >= 3
 AND contains({NORM.format(c='title')}, {NORM.format(c='n.name')})"""))
def j06(spark, sf):
    known = D.names(spark, sf).select(D.code_of(F.col("k")).alias("code"), "name")
    return asof.name_mentions(D.news(spark, sf).select("doc_id", "title"), known).select("doc_id", "code")


@query("j07_announcements_of_features", C.with_ctes(C.BARS, C.MESSAGES.replace(C.NAMES + ",", ""), select="""
SELECT lpad(stock_code, 6, '0') AS code, count(*) AS n_announcements FROM messages
WHERE kind = 'announcement' AND lpad(stock_code, 6, '0') IN (SELECT code FROM bars) GROUP BY 1"""))
def j07(spark, sf):
    known = D.bars(spark, sf).select("code").distinct()
    ann = D.messages(spark, sf).where("kind = 'announcement'").select(F.lpad("stock_code", 6, "0").alias("code"))
    return ann.join(known, "code", "left_semi").groupBy("code").agg(F.count(F.lit(1)).alias("n_announcements"))


@query("a14_event_counters", C.with_ctes(PANEL, EVENTS, select="""
SELECT mode, decision_no, code, ann_count, news_mentions, risk_hits, positive_hits FROM feat WHERE ann_count + news_mentions > 0"""))
def a14(spark, sf):
    f = signals(spark, sf).features.where("ann_count + news_mentions > 0")
    return f.select("mode", "decision_no", "code", "ann_count", "news_mentions", "risk_hits", "positive_hits")


@query("j18_zero_filled_events", C.with_ctes(PANEL, EVENTS, select="""
SELECT mode, decision_no, count(*) AS n_features, sum(ann_count)::bigint AS ann_count, sum(news_mentions)::bigint AS news_mentions FROM feat GROUP BY 1, 2"""))
def j18(spark, sf):
    return signals(spark, sf).features.groupBy("mode", "decision_no").agg(
        F.count(F.lit(1)).alias("n_features"), F.sum("ann_count").alias("ann_count"), F.sum("news_mentions").alias("news_mentions")
    )


@query("p13_common_gate", C.with_ctes(PANEL, EVENTS, select=f"SELECT mode, decision_no, code FROM feat WHERE {GATE}"))
def p13(spark, sf):
    return signals(spark, sf).features.where(channels.common_gate()).select("mode", "decision_no", "code")


@query("c04_channel_scores", C.with_ctes(PANEL, EVENTS, SCORES, select="SELECT mode, decision_no, channel, code, round(raw_score, 4) AS score FROM scores"))
def c04(spark, sf):
    return signals(spark, sf).scores.select("mode", "decision_no", "channel", "code", F.round("score", 4).alias("score"))


@query("k02_channel_top3", C.with_ctes(PANEL, EVENTS, SCORES, select="SELECT mode, decision_no, channel, rank, code, name, round(raw_score, 4) AS score, positive_hits, news_mentions FROM picks"))
def k02(spark, sf):
    return signals(spark, sf).picks.select("mode", "decision_no", "channel", "rank", "code", "name", "score", "positive_hits", "news_mentions")


@query("a13_consensus_votes", C.with_ctes(PANEL, EVENTS, SCORES, select="SELECT mode, decision_no, rank, code, votes, channels FROM agreed"))
def a13(spark, sf):
    return signals(spark, sf).consensus.select("mode", "decision_no", "rank", "code", "votes", F.array_join("channels", ",").alias("channels"))


@query("a15_eligible_counts", C.with_ctes(PANEL, EVENTS, SCORES, select="""
SELECT 'eligible' AS what, mode, channel, count(*) AS n FROM scores GROUP BY 2, 3
UNION ALL SELECT 'days', mode, channel, count(*) FROM picks WHERE rank = 1 GROUP BY 2, 3"""))
def a15(spark, sf):
    s = signals(spark, sf)
    eligible = s.eligible.groupBy("mode", "channel").agg(F.sum("eligible").alias("n")).withColumn("what", F.lit("eligible"))
    days = channels.days_with_pick(s.picks).withColumnRenamed("days_with_pick", "n").withColumn("what", F.lit("days"))
    return eligible.unionByName(days)


@query("c05_replay_decisions", C.with_ctes(PANEL, EVENTS, SCORES, select="""
SELECT d.mode, d.decision_no, d.as_of_no, strftime(d.cutoff, '%Y-%m-%d %H:%M:%S') AS cutoff, coalesce(n_news, 0) AS visible_news_count,
 coalesce(n_ann, 0) AS visible_announcement_count, coalesce(n_feat, 0) AS feature_stock_count, coalesce(e.t, '') AS eligible
FROM decisions d
LEFT JOIN (SELECT x.mode, x.decision_no, count(*) FILTER (kind = 'news') AS n_news, count(*) FILTER (kind = 'announcement') AS n_ann
  FROM messages m JOIN decisions x ON m.stamp BETWEEN x.lower AND x.cutoff GROUP BY 1, 2) v ON v.mode = d.mode AND v.decision_no = d.decision_no
LEFT JOIN (SELECT mode, decision_no, count(*) AS n_feat FROM feat GROUP BY 1, 2) f ON f.mode = d.mode AND f.decision_no = d.decision_no
LEFT JOIN (SELECT mode, decision_no, string_agg(channel || '=' || n, ',' ORDER BY channel) AS t FROM (SELECT mode, decision_no, channel, count(*) AS n FROM scores GROUP BY 1, 2, 3) GROUP BY 1, 2) e
 ON e.mode = d.mode AND e.decision_no = d.decision_no"""))
def c05(spark, sf):
    s = signals(spark, sf)
    t = P.decision_table(s, D.messages(spark, sf))
    pairs = F.transform(F.map_entries("eligible_counts"), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string")))
    return t.select(
        "mode", "decision_no", "as_of_no", F.substring(F.col("cutoff").cast("string"), 1, 19).alias("cutoff"), "visible_news_count",
        "visible_announcement_count", "feature_stock_count", F.coalesce(F.array_join(pairs, ","), F.lit("")).alias("eligible"),
    )


@query("j04_next_session_outcomes", C.with_ctes(PANEL, EVENTS, SCORES, select='SELECT mode, decision_no, code, grp AS "group", status, next_open_return, next_high_return, next_low_return, next_close_return, red_window, positive_open, positive_close, no_red FROM outcomes'))
def j04(spark, sf):
    return outcomes(spark, sf).drop("entry_price", "next_date")


RATES = ("red_window_rate", "positive_open_rate", "positive_close_rate", "no_red_rate", "mean_open_return", "median_high_return",
         "mean_high_return", "median_close_return", "mean_close_return", "worst_low_return")


@query("a12_outcome_summary", C.with_ctes(PANEL, EVENTS, SCORES, select='SELECT mode, "group", samples, ' + ", ".join(f"round({r}, 3) AS {r}" for r in RATES) + " FROM summary"))
def a12(spark, sf):
    out = asof.outcome_summary(outcomes(spark, sf), ["mode", "group"])
    return out.select("mode", "group", "samples", *[F.round(r, 3).alias(r) for r in RATES])


@query("k10_summary_order", C.with_ctes(PANEL, EVENTS, SCORES, select='SELECT mode, "group", row_number() OVER (PARTITION BY mode ORDER BY red_window_rate DESC, round(median_high_return, 6) DESC, "group") AS place FROM summary'))
def k10(spark, sf):
    from pyspark.sql import Window

    out = asof.outcome_summary(outcomes(spark, sf), ["mode", "group"])
    w = Window.partitionBy("mode").orderBy(F.desc("red_window_rate"), F.desc(F.round("median_high_return", 6)), "group")
    return out.select("mode", "group", F.row_number().over(w).alias("place"))


@query("c06_outcome_evaluation", C.with_ctes(PANEL, EVENTS, SCORES, select='SELECT mode, "group", samples, round(red_window_rate, 3) AS red_window_rate, round(worst_low_return, 3) AS worst_low_return FROM summary WHERE "group" LIKE \'CONSENSUS%\''))
def c06(spark, sf):
    records = outcomes(spark, sf).where(F.col("group").startswith("CONSENSUS"))
    out = asof.outcome_summary(records, ["mode", "group"])
    return out.select("mode", "group", "samples", F.round("red_window_rate", 3).alias("red_window_rate"), F.round("worst_low_return", 3).alias("worst_low_return"))


@query("p22_public_picks", C.with_ctes(PANEL, EVENTS, SCORES, select=f"SELECT mode, decision_no, channel, rank, code, name, round(raw_score, 4) AS score, round(close, 4) AS close, round(ret10, 4) AS ret10, round({L}, 4) AS liquidity, ann_count FROM picks"))
def p22(spark, sf):
    return signals(spark, sf).picks.select(
        "mode", "decision_no", "channel", "rank", "code", "name", "score", F.round("close", 4).alias("close"),
        F.round("ret10", 4).alias("ret10"), F.round(L, 4).alias("liquidity"), "ann_count",
    )


@query("c23_leakage_audit", C.with_ctes(PANEL, EVENTS, SCORES, select="""
SELECT d.mode, d.decision_no::int AS decision_no, 'future message' AS violation FROM decisions d
 WHERE d.decision_no % 5 = 0 AND EXISTS (SELECT 1 FROM messages m WHERE m.stamp BETWEEN d.lower AND d.cutoff)
UNION ALL SELECT mode, decision_no::int, 'wrong market anchor' FROM decisions WHERE decision_no % 7 = 3
UNION ALL SELECT mode, decision_no::int, 'seal mismatch' FROM picks WHERE rank = 2 AND decision_no % 3 = 1"""))
def c23(spark, sf):
    """Stored signals with planted faults: late messages, shifted anchors and picks changed after they were sealed."""
    s = signals(spark, sf)
    no = F.col("decision_no")
    maxima = staged(P.visible_maxima(D.messages(spark, sf), s.decisions), "maxima")
    late = F.when(no % 5 == 0, F.expr("INTERVAL 5 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    decided = s.decisions.withColumn("as_of_no", F.col("as_of_no") + F.when(no % 7 == 3, 1).otherwise(0))
    picks = staged(P.sealed(s.picks), "sealed")
    picks = picks.withColumn("code", F.when((F.col("rank") == 2) & (no % 3 == 1), F.concat("code", F.lit("x"))).otherwise(F.col("code")))
    out = P.leakage_audit(decided, maxima.withColumn("latest", F.col("latest") + late), picks)
    return out.withColumn("decision_no", F.col("decision_no").cast("int"))


@query("x33_content_hash", C.with_ctes(PANEL, EVENTS, SCORES, select="""
SELECT mode, decision_no, channel, rank, sha256('{"channel":"' || channel || '","code":"' || code || '","decision_no":' || decision_no::varchar || ',"mode":"' || mode || '","rank":' || rank::varchar || '}') AS seal
FROM picks"""))
def x33(spark, sf):
    from tapeline.functions.hashing import content_hash

    picks = signals(spark, sf).picks
    return picks.select("mode", "decision_no", "channel", "rank", content_hash(picks, ["mode", "decision_no", "channel", "rank", "code"]).alias("seal"))
