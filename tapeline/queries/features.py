"""Trailing feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.operators import features as X
from tapeline.operators import market as M
from tapeline.queries import ctes as C
from tapeline.queries.registry import query
from tapeline.sources import driver_tables as D

HIST = C.BARS + """,
h0 AS (SELECT *, coalesce(prev_close, 0.0) AS pc0,
  last_value(CASE WHEN close > 0 THEN close END IGNORE NULLS) OVER (PARTITION BY code ORDER BY session_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen,
  max(session_no) OVER () AS top_no FROM bars),
h1 AS (SELECT *, list(close) OVER w AS closes, list(amount) OVER w AS amounts, list(volume) OVER w AS volumes, list(high) OVER w AS highs,
  list(low) OVER w AS lows, list(pc0) OVER w AS pcs, list(session) OVER w AS days FROM h0
  WINDOW w AS (PARTITION BY code ORDER BY session_no RANGE BETWEEN 24 PRECEDING AND CURRENT ROW)),
h AS (SELECT *, len(closes)::int AS n,
  list_transform(range(1, len(closes) + 1), lambda i: CASE
    WHEN pcs[i] > 0 THEN greatest(highs[i] - lows[i], abs(highs[i] - pcs[i]), abs(lows[i] - pcs[i]))
    WHEN i > 1 THEN greatest(highs[i] - lows[i], abs(highs[i] - closes[i-1]), abs(lows[i] - closes[i-1]))
    ELSE highs[i] - lows[i] END) AS trs FROM h1)"""


def ma(n: int) -> str:
    return f"CASE WHEN n >= {n} THEN round(list_sum(closes[-{n}:]) / {n}, 4) END"


def ret(n: int) -> str:
    return f"CASE WHEN n > {n} THEN round((close / closes[-{n + 1}] - 1) * 100, 4) END"


def rises(c: str) -> str:
    return (
        f"(n - 1 - coalesce(list_max(list_filter(range(1, n), lambda i: NOT ({c}[i] > 0 AND {c}[i+1] > {c}[i]))), 0))::int"
    )


AVG5 = "CASE WHEN n >= 6 THEN list_sum({c}[-6:-2]) / 5 END"
AA, AV = AVG5.format(c="amounts"), AVG5.format(c="volumes")
ATR = "CASE WHEN n >= 14 THEN list_sum(trs[-14:]) / 14 END"
RH, RL = "list_max(highs[-15:])", "list_min(lows[-15:])"


@query("w01_moving_averages", C.with_ctes(HIST, select=f"SELECT code, session, {ma(5)} AS ma5, {ma(10)} AS ma10, {ma(15)} AS ma15, {ma(20)} AS ma20 FROM h"))
def w01(spark, sf):
    return X.objective_features(D.bars(spark, sf)).select("code", "session", "ma5", "ma10", "ma15", "ma20")


@query("w02_returns", C.with_ctes(HIST, select=f"SELECT code, session, {ret(5)} AS return_5d, {ret(10)} AS return_10d, {ret(15)} AS return_15d FROM h"))
def w02(spark, sf):
    return X.objective_features(D.bars(spark, sf)).select("code", "session", "return_5d", "return_10d", "return_15d")


@query("w03_five_session_averages", C.with_ctes(HIST, select=f"""
SELECT code, session, round({AA}, 2) AS average_amount_5d, round(amount / ({AA}), 4) AS amount_ratio_5d,
 round({AV}, 2) AS average_volume_5d, round(volume / ({AV}), 4) AS volume_ratio_5d FROM h"""))
def w03(spark, sf):
    return X.objective_features(D.bars(spark, sf)).select(
        "code", "session", "average_amount_5d", "amount_ratio_5d", "average_volume_5d", "volume_ratio_5d"
    )


@query("w04_average_true_range", C.with_ctes(HIST, select=f"SELECT code, session, round({ATR}, 4) AS atr14, round(({ATR}) / close * 100, 4) AS atr14_pct FROM h"))
def w04(spark, sf):
    return X.objective_features(D.bars(spark, sf)).select("code", "session", "atr14", "atr14_pct")


@query("w05_range_position", C.with_ctes(HIST, select=f"""
SELECT code, session, round({RH}, 4) AS range_high_15d, round({RL}, 4) AS range_low_15d,
 CASE WHEN {RH} > {RL} THEN round((close - {RL}) / ({RH} - {RL}), 4) END AS range_position_15d FROM h"""))
def w05(spark, sf):
    return X.objective_features(D.bars(spark, sf)).select("code", "session", "range_high_15d", "range_low_15d", "range_position_15d")


@query("w06_rising_runs", C.with_ctes(HIST, select=f"""
SELECT code, session, {rises('amounts')} AS consecutive_amount_increases, {rises('volumes')} AS consecutive_volume_increases FROM h"""))
def w06(spark, sf):
    return X.objective_features(D.bars(spark, sf)).select(
        "code", "session", "consecutive_amount_increases", "consecutive_volume_increases"
    )


@query("w07_recent_series", C.with_ctes(HIST, select="""
SELECT code, session, array_to_string(list_transform(days[-15:], lambda d: strftime(d, '%Y%m%d')), ',') AS dates,
 list_sum(list_transform(highs[-15:], lambda v: round(v * 10000)::bigint))::bigint AS high_sum, list_sum(list_transform(lows[-15:], lambda v: round(v * 10000)::bigint))::bigint AS low_sum FROM h"""))
def w07(spark, sf):
    f = X.objective_features(D.bars(spark, sf))
    total = lambda c, k: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + F.round(x[k] * 10000).cast("bigint"))
    return f.select(
        "code", "session",
        F.array_join(F.transform("history_dates", lambda d: F.date_format(d, "yyyyMMdd")), ",").alias("dates"),
        total("recent_high_series", "high").alias("high_sum"), total("recent_low_series", "low").alias("low_sum"),
    )


@query("x27_candle_shapes", C.with_ctes(C.BARS, select="""
SELECT code, session, round((high - greatest(open, close)) / nullif(high - low, 0), 4) AS upper_shadow_ratio,
 round((least(open, close) - low) / nullif(high - low, 0), 4) AS lower_shadow_ratio,
 round(abs(close - open) / nullif(high - low, 0), 4) AS body_ratio FROM bars"""))
def x27(spark, sf):
    return X.objective_features(D.bars(spark, sf)).select("code", "session", "upper_shadow_ratio", "lower_shadow_ratio", "body_ratio")


OBJECTIVE = f"""
SELECT code, name, session, close AS price, coalesce(pct, 0.0) AS pct, amount, volume, turnover, volume_ratio, coalesce(amplitude, 0.0) AS amplitude,
 {ma(5)} AS ma5, {ma(10)} AS ma10, {ma(15)} AS ma15, {ma(20)} AS ma20, {ret(5)} AS return_5d, {ret(10)} AS return_10d, {ret(15)} AS return_15d,
 round({AA}, 2) AS average_amount_5d, round(amount / ({AA}), 4) AS amount_ratio_5d, round({AV}, 2) AS average_volume_5d, round(volume / ({AV}), 4) AS volume_ratio_5d,
 {rises('amounts')} AS consecutive_amount_increases, {rises('volumes')} AS consecutive_volume_increases,
 round({ATR}, 4) AS atr14, round(({ATR}) / close * 100, 4) AS atr14_pct, round({RH}, 4) AS range_high_15d, round({RL}, 4) AS range_low_15d,
 CASE WHEN {RH} > {RL} THEN round((close - {RL}) / ({RH} - {RL}), 4) END AS range_position_15d, n AS history_points FROM h"""
OBJECTIVE_COLUMNS = (
    "code name session price pct amount volume turnover volume_ratio amplitude ma5 ma10 ma15 ma20 return_5d return_10d return_15d "
    "average_amount_5d amount_ratio_5d average_volume_5d volume_ratio_5d consecutive_amount_increases consecutive_volume_increases "
    "atr14 atr14_pct range_high_15d range_low_15d range_position_15d history_points"
).split()


@query("c01_objective_features", C.with_ctes(HIST, select=OBJECTIVE))
def c01(spark, sf):
    return X.objective_features(D.bars(spark, sf)).select(*OBJECTIVE_COLUMNS)


@query("j01_features_as_of", C.with_ctes(HIST, f", f AS ({OBJECTIVE})".lstrip(", "), select="""
SELECT code, session, price, ma5, history_points FROM f WHERE session = (SELECT max(session) FROM f WHERE session <= date '1998-06-30')"""))
def j01(spark, sf):
    f = X.objective_features(D.bars(spark, sf))
    return X.features_as_of(f, F.lit("1998-06-30").cast("date")).select("code", "session", "price", "ma5", "history_points")


SCREEN = "amount >= 200000000 AND pct >= -5 AND pct <= 5 AND turnover >= 1 AND range_position_15d <= 0.6"
SCREEN_ARGS = dict(min_amount=2e8, min_pct=-5, max_pct=5, min_turnover=1, max_range_position=0.6)


@query("p07_feature_screen", C.with_ctes(HIST, f"f AS ({OBJECTIVE})", select=f"SELECT code, session, pct, amount, range_position_15d FROM f WHERE {SCREEN}"))
def p07(spark, sf):
    return M.feature_screen(X.objective_features(D.bars(spark, sf)), **SCREEN_ARGS).select("code", "session", "pct", "amount", "range_position_15d")


@query("k08_screen_page", C.with_ctes(HIST, f"f AS ({OBJECTIVE})", select=f"""
SELECT code, session, amount_ratio_5d, (SELECT count(*) FROM f WHERE {SCREEN}) AS total_matches FROM f WHERE {SCREEN}
ORDER BY coalesce(amount_ratio_5d, 0.0) DESC, code, session LIMIT 50"""))
def k08(spark, sf):
    matches = M.feature_screen(X.objective_features(D.bars(spark, sf)), **SCREEN_ARGS)
    page = M.screen_page(matches, "amount_ratio_5d", ties=("code", "session"))
    return page.select("code", "session", "amount_ratio_5d", "total_matches")


# --- replay family ---------------------------------------------------------------------------------------

REPLAY = C.BARS + """,
r0 AS (SELECT *, row_number() OVER w AS n, lag(close) OVER w AS p, lag(close, 3) OVER w AS c3, lag(close, 5) OVER w AS c5, lag(close, 10) OVER w AS c10,
  lead(session_no) OVER w AS next_no FROM bars WINDOW w AS (PARTITION BY code ORDER BY session_no)),
r1 AS (SELECT *, CASE WHEN p IS NOT NULL THEN (high - low) / close * 100.0 END AS rng,
  CASE WHEN p IS NOT NULL THEN greatest(high - low, abs(high - p), abs(low - p)) / p * 100.0 END AS tr, (close / p - 1.0) * 100.0 AS chg FROM r0),
r2 AS (SELECT *,
  CASE WHEN n >= 3 THEN avg(close) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS ma3,
  CASE WHEN n >= 5 THEN avg(close) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) END AS ma5,
  CASE WHEN n >= 10 THEN avg(close) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END AS ma10,
  CASE WHEN n >= 15 THEN avg(close) OVER (w ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) END AS ma15,
  avg(volume) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS vol5,
  max(high) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS prior_high10,
  max(high) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS high10, min(low) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS low10,
  avg(close) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS prev_ma3,
  list_filter(list(rng) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL) AS rngs,
  list_filter(list(tr) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL) AS trs,
  list_filter(list(chg) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL) AS chgs
  FROM r1 WINDOW w AS (PARTITION BY code ORDER BY session_no)),
rf AS (SELECT *, CASE WHEN n > 3 THEN (close / c3 - 1.0) * 100.0 END AS ret3, CASE WHEN n > 5 THEN (close / c5 - 1.0) * 100.0 END AS ret5,
  CASE WHEN n > 10 THEN (close / c10 - 1.0) * 100.0 END AS ret10, close * volume AS liquidity_proxy, volume / nullif(vol5, 0) AS volume_ratio5,
  CASE WHEN high10 > low10 THEN (close - low10) / (high10 - low10) END AS range_position10, (close / high10 - 1.0) * 100.0 AS drawdown_high10,
  CASE WHEN high > low THEN (close - low) / (high - low) ELSE 0.5 END AS close_position,
  (high - greatest(open, close)) / close AS upper_shadow, (least(open, close) - low) / close AS lower_shadow, abs(close - open) / close AS body_ratio,
  list_avg(rngs[-3:]) / nullif(list_avg(CASE WHEN len(rngs) > 3 THEN rngs[greatest(len(rngs) - 7, 1):len(rngs) - 3] ELSE [] END), 0) AS compression,
  list_avg(trs[-5:]) AS atr5, list_avg(trs) AS atr10,
  len(list_filter(chgs[-3:], lambda x: x < 0))::int AS pullback_days3, len(list_filter(chgs, lambda x: x > 0))::int AS positive_days5,
  len(list_filter(chgs[-3:], lambda x: x >= 5.0))::int AS big_gain_days3, coalesce(close > ma3 AND p <= prev_ma3, false) AS cross_ma3,
  n >= 8 AND substr(code, 1, 3) IN ('000','001','002','003','600','601','603','605') AND name <> '' AND NOT contains(upper(name), 'ST')
  AND close BETWEEN 2 AND 250 AND volume > 0 AS is_tradable FROM r2)"""


def replay(spark, sf):
    return X.replay_features(D.bars(spark, sf))


def _rounded(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 4) AS {c}" for c in cols)


def register(name: str, numeric: list[str], exact: list[str] = ()):
    """A query over some replay feature columns, numbers rounded to 4 places on both sides."""
    keep = ", ".join(["code", "session", *exact])

    def run(spark, sf):
        return replay(spark, sf).select("code", "session", *exact, *[F.round(c, 4).alias(c) for c in numeric])

    extra = ", " + _rounded(numeric) if numeric else ""
    query(name, C.with_ctes(REPLAY, select=f"SELECT {keep}{extra} FROM rf"))(run)


register("w08_replay_moving_averages", ["ma3", "ma5", "ma10", "ma15"])
register("w09_replay_returns", ["ret3", "ret5", "ret10"])
register("w10_volume_ratio", ["volume_ratio5"])
register("w11_ten_session_range", ["prior_high10", "range_position10", "drawdown_high10"])
register("w12_compression", ["compression"])
register("w13_true_range_percent", ["atr5", "atr10"])
register("w14_recent_days", [], ["pullback_days3", "positive_days5", "big_gain_days3"])
register("w15_cross_ma3", [], ["cross_ma3"])
register("p03_replay_tradability", ["close", "liquidity_proxy"], ["is_tradable"])
register("x27_replay_shapes", ["close_position", "upper_shadow", "lower_shadow", "body_ratio"])
