"""Trailing price and volume features for every code and session.

Two families. The objective panel counts a code's own observations inside the last ``history`` market sessions;
the replay panel counts own observations without that bound. All windows of a family share one sort by code.
A code has at most one row per session, so a window partition never exceeds the number of sessions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions import codes
from tapeline.functions.folds import array_mean, from_end, last_n, mean_last, return_last
from tapeline.functions.numbers import num0, or_else, pct_change, ratio

HISTORY_SESSIONS = 25


def day_shape(open_: Column, high: Column, low: Column, close: Column) -> dict[str, Column]:
    """Shadows and body as shares of the day's range; null on a flat day."""
    span = F.when(high - low > 0, high - low)
    return {
        "upper_shadow_ratio": (high - F.greatest(open_, close)) / span,
        "lower_shadow_ratio": (F.least(open_, close) - low) / span,
        "body_ratio": F.abs(close - open_) / span,
    }


def _trailing_rises(arr: Column) -> Column:
    """Length of the final run of strict increases over positive values."""
    rises = F.transform(
        F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(0))),
        lambda x, i: (F.get(arr, i) > 0) & (x > F.get(arr, i)),
    )
    stop = F.array_position(F.reverse(rises), False)
    return F.when(stop > 0, stop - 1).otherwise(F.size(rises)).cast("int")


def _true_ranges(hist: Column) -> Column:
    """True range of each bar with usable high and low; the reference close is the given previous close or the
    last positive close seen in the history."""

    def one(x: Column, i: Column) -> Column:
        earlier = F.filter(F.transform(F.slice(hist, F.lit(1), i), lambda y: y["close"]), lambda c: c > 0)
        ref = F.when(x["prev_close"] > 0, x["prev_close"]).otherwise(from_end(earlier, 0))
        span = x["high"] - x["low"]
        wide = F.greatest(span, F.abs(x["high"] - ref), F.abs(x["low"] - ref))
        ok = (x["high"] > 0) & (x["low"] > 0) & (x["high"] >= x["low"])
        return F.when(ok, F.when(ref > 0, wide).otherwise(span))

    return F.filter(F.transform(hist, one), lambda r: r.isNotNull())


def with_history(bars: DataFrame, history: int = HISTORY_SESSIONS) -> DataFrame:
    """Cleaned bars with ``hist``: own bars of the last ``history`` market sessions, oldest first."""
    numeric = dict(bars.dtypes)
    clean = lambda c: num0(c) if numeric[c] == "string" else F.coalesce(F.col(c), F.lit(0.0))
    cols = ("open", "high", "low", "close", "prev_close", "amount", "volume")
    base = bars.withColumns({c: clean(c) for c in cols})
    w = Window.partitionBy("code").orderBy("session_no").rangeBetween(-(history - 1), 0)
    point = F.struct("session", "close", "high", "low", "prev_close", "amount", "volume")
    return base.withColumn("hist", F.collect_list(point).over(w))


def objective_features(bars: DataFrame, history: int = HISTORY_SESSIONS) -> DataFrame:
    """The objective feature row of every code and session, as of that session."""
    df = with_history(bars, history)
    hist = F.col("hist")
    pick = lambda c: F.transform(hist, lambda x: x[c])
    df = df.withColumns(
        {
            "_closes": F.filter(pick("close"), lambda c: c > 0),
            "_amounts": pick("amount"),
            "_volumes": pick("volume"),
            "_tr": _true_ranges(hist),
            "_hi": F.filter(last_n(pick("high"), 15), lambda v: v > 0),
            "_lo": F.filter(last_n(pick("low"), 15), lambda v: v > 0),
        }
    )
    closes, price = F.col("_closes"), F.col("close")
    previous5 = lambda a: F.when(F.size(a) >= 6, array_mean(F.slice(a, F.size(a) - 5, F.lit(5))))
    df = df.withColumns(
        {
            "_aa": previous5(F.col("_amounts")),
            "_av": previous5(F.col("_volumes")),
            "_atr": mean_last(F.col("_tr"), 14),
            "_rh": F.array_max("_hi"),
            "_rl": F.array_min("_lo"),
        }
    )
    shape = day_shape(F.col("open"), F.col("high"), F.col("low"), price)
    rounded = {f"ma{n}": mean_last(closes, n) for n in (5, 10, 15, 20)}
    rounded |= {f"return_{n}d": return_last(closes, n) for n in (5, 10, 15)}
    rounded |= {
        "amount_ratio_5d": ratio("amount", "_aa"),
        "volume_ratio_5d": ratio("volume", "_av"),
        "atr14": F.col("_atr"),
        "atr14_pct": F.when(price > 0, F.col("_atr") / price * 100),
        "range_high_15d": F.col("_rh"),
        "range_low_15d": F.col("_rl"),
        "range_position_15d": F.when(F.col("_rh") > F.col("_rl"), (price - F.col("_rl")) / (F.col("_rh") - F.col("_rl"))),
    } | shape
    tail = last_n(hist, 15)
    zero = lambda c: (F.coalesce(F.col(c), F.lit(0.0)) if c in bars.columns else F.lit(0.0)).alias(c)
    return df.select(
        "code", "name", "session", "session_no", price.alias("price"),
        *[zero(c) for c in ("pct", "turnover", "volume_ratio", "amplitude")],
        "amount", "volume", "open", "high", "low", "prev_close",
        *[F.round(e, 4).alias(n) for n, e in rounded.items()],
        F.round("_aa", 2).alias("average_amount_5d"),
        F.round("_av", 2).alias("average_volume_5d"),
        _trailing_rises(F.col("_amounts")).alias("consecutive_amount_increases"),
        _trailing_rises(F.col("_volumes")).alias("consecutive_volume_increases"),
        F.size(hist).alias("history_points"),
        F.transform(tail, lambda x: x["session"]).alias("history_dates"),
        F.transform(tail, lambda x: F.struct(x["session"].alias("session"), F.round(x["high"], 4).alias("high"))).alias("recent_high_series"),
        F.transform(tail, lambda x: F.struct(x["session"].alias("session"), F.round(x["low"], 4).alias("low"))).alias("recent_low_series"),
    )


def features_as_of(features: DataFrame, as_of: Column) -> DataFrame:
    """Feature rows of the newest session not after ``as_of``; the scan is cut to that session."""
    newest = features.where(F.col("session") <= as_of).groupBy().agg(F.max("session"))
    return features.where(F.col("session") == newest.scalar())


# --- replay panel ---------------------------------------------------------------------------------------


def replay_features(bars: DataFrame, min_history: int = 8, close_range: tuple[float, float] = (2.0, 250.0)) -> DataFrame:
    """Features the factor channels read, for every code and session that passes the tradability rules.

    ``bars`` may carry ``last_price`` / ``open_price`` as second choices for close and open.
    """
    w = Window.partitionBy("code").orderBy("session_no")
    rows = lambda lo, hi: w.rowsBetween(lo, hi)
    close = or_else("close", "last_price") if "last_price" in bars.columns else F.nullif(F.col("close"), F.lit(0.0))
    open_ = or_else("open", "open_price") if "open_price" in bars.columns else F.nullif(F.col("open"), F.lit(0.0))
    base = bars.select(
        "code", "name", "session", "session_no", close.alias("close"), open_.alias("open"), "high", "low", "volume", "pct"
    )
    c, h, l = F.col("close"), F.col("high"), F.col("low")
    prev = F.lag("close", 1).over(w)
    base = base.withColumns({"_n": F.row_number().over(w), "_prev": prev})
    p = F.col("_prev")
    usable = c.isNotNull() & h.isNotNull() & l.isNotNull() & (p != 0)
    base = base.withColumns(
        {
            "_range": F.when(usable, (h - l) / c * 100.0),
            "_tr": F.when(usable, F.greatest(h - l, F.abs(h - p), F.abs(l - p)) / p * 100.0),
            "_chg": pct_change("close", "_prev"),
        }
    )
    frames = {f"ma{n}": F.when(F.col("_n") >= n, F.avg("close").over(rows(-(n - 1), 0))) for n in (3, 5, 10, 15)}
    frames |= {f"_c{n}": F.lag("close", n).over(w) for n in (3, 5, 10)}
    frames |= {
        "_vol5": F.avg("volume").over(rows(-5, -1)),
        "prior_high10": F.max("high").over(rows(-10, -1)),
        "_high10": F.max("high").over(rows(-9, 0)),
        "_low10": F.min("low").over(rows(-9, 0)),
        "_prev_ma3": F.avg("close").over(rows(-3, -1)),
        "_ranges": F.collect_list("_range").over(rows(-9, 0)),
        "_trs": F.collect_list("_tr").over(rows(-9, 0)),
        "_chgs": F.collect_list("_chg").over(rows(-4, 0)),
    }
    df = base.withColumns(frames)
    recent = array_mean(last_n(F.col("_ranges"), 3))
    prior = array_mean(F.slice("_ranges", F.greatest(F.size("_ranges") - 7, F.lit(1)), F.greatest(F.least(F.size("_ranges") - 3, F.lit(5)), F.lit(0))))
    span = F.greatest(h - l, F.lit(0.0))
    open_c = F.col("open")
    count = lambda arr, test: F.size(F.filter(arr, test))
    out = {f"ret{n}": F.when(F.col("_n") > n, pct_change("close", f"_c{n}")) for n in (3, 5, 10)}
    out |= {
        "pct": F.coalesce(F.col("pct"), F.col("_chg")),
        "liquidity_proxy": c * F.col("volume"),
        "volume_ratio5": ratio("volume", "_vol5"),
        "range_position10": F.when(F.col("_high10") > F.col("_low10"), (c - F.col("_low10")) / (F.col("_high10") - F.col("_low10"))),
        "drawdown_high10": pct_change("close", "_high10"),
        "close_position": F.when(span != 0, (c - l) / span).otherwise(F.lit(0.5)),
        "upper_shadow": (h - F.greatest(open_c, c)) / c,
        "lower_shadow": (F.least(open_c, c) - l) / c,
        "body_ratio": F.abs(c - open_c) / c,
        "compression": recent / F.nullif(prior, F.lit(0.0)),
        "atr5": array_mean(last_n(F.col("_trs"), 5)),
        "atr10": array_mean(F.col("_trs")),
        "pullback_days3": count(last_n(F.col("_chgs"), 3), lambda x: x < 0),
        "positive_days5": count(F.col("_chgs"), lambda x: x > 0),
        "big_gain_days3": count(last_n(F.col("_chgs"), 3), lambda x: x >= 5.0),
        "cross_ma3": F.coalesce((c > F.col("ma3")) & (p <= F.col("_prev_ma3")), F.lit(False)),
        "next_session_no": F.lead("session_no").over(w),
    }
    df = df.withColumns(out)
    present = c.isNotNull() & open_c.isNotNull() & h.isNotNull() & l.isNotNull() & F.col("volume").isNotNull()
    kept = (
        present & (F.col("_n") >= min_history) & codes.is_main_board("code", "name") & (F.coalesce("name", F.lit("")) != "")
        & c.between(*close_range) & (F.col("volume") > 0)
    )
    return df.withColumn("is_tradable", F.coalesce(kept, F.lit(False))).drop(*[x for x in df.columns if x.startswith("_")])
