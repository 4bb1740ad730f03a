"""Folds over bounded arrays: moving averages, EMA and MACD."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)


def array_mean(arr: Column) -> Column:
    """Mean of a bounded double array; null for an empty one."""
    return array_sum(arr) / F.nullif(F.size(arr), F.lit(0))


def last_n(arr: Column, n: int) -> Column:
    """The last ``n`` entries, or all of them when there are fewer."""
    return F.slice(arr, F.greatest(F.size(arr) - n + 1, F.lit(1)), F.lit(n))


def from_end(arr: Column, k: int) -> Column:
    """Entry ``k`` places before the last one (0 is the last); null past the start."""
    return F.get(arr, F.size(arr) - 1 - k)


def mean_last(arr: Column, n: int) -> Column:
    """Mean of the last ``n``; null until there are ``n``."""
    return F.when(F.size(arr) >= n, array_mean(last_n(arr, n)))


def return_last(arr: Column, n: int) -> Column:
    """Percent change against the value ``n`` places earlier; null when short or the base is not positive."""
    base = from_end(arr, n)
    return F.when((F.size(arr) > n) & (base > 0), (from_end(arr, 0) / base - 1) * 100)


def ema(arr: Column, span: int) -> Column:
    """Exponential moving average series seeded with the first value."""
    alpha = 2.0 / (span + 1)
    seed = F.slice(arr, 1, 1)
    return F.aggregate(
        _rest(arr), seed, lambda acc, x: F.concat(acc, F.array(F.lit(alpha) * x + F.lit(1 - alpha) * F.element_at(acc, -1)))
    )


def ema_last(arr: Column, span: int) -> Column:
    """Last value of ``ema``; null for an empty array."""
    alpha = 2.0 / (span + 1)
    return F.aggregate(_rest(arr), F.get(arr, F.lit(0)), lambda acc, x: F.lit(alpha) * x + F.lit(1 - alpha) * acc)


def _rest(arr: Column) -> Column:
    return F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(0)))


def macd(arr: Column) -> Column:
    """MACD 12/26/9 of a close array as a struct; under twelve values it is ``insufficient_history``.

    One fold keeps both averages, the signal line and what the two steps before had: as much for each value as for the first.
    """
    first, none = F.get(arr, F.lit(0)), F.lit(None).cast("double")
    seed = F.struct(first.alias("fast"), first.alias("slow"), (first - first).alias("dea"), none.alias("dif1"), none.alias("dea1"), none.alias("dif2"), none.alias("dea2"))

    def step(acc: Column, x: Column) -> Column:
        to = lambda span, value, before: F.lit(2.0 / (span + 1)) * value + F.lit(1 - 2.0 / (span + 1)) * before
        fast, slow = to(12, x, acc["fast"]), to(26, x, acc["slow"])
        return F.struct(
            fast.alias("fast"), slow.alias("slow"), to(9, fast - slow, acc["dea"]).alias("dea"),
            (acc["fast"] - acc["slow"]).alias("dif1"), acc["dea"].alias("dea1"), acc["dif1"].alias("dif2"), acc["dea1"].alias("dea2"),
        )

    enough = F.size(arr) >= 12
    short = F.struct(
        *[F.lit(None).cast("double").alias(n) for n in ("dif", "dea", "histogram", "previous_histogram")],
        F.lit("insufficient_history").alias("state"),
        F.lit(False).alias("slope_up"),
    )
    return F.when(enough, F.aggregate(_rest(arr), seed, step, _macd_state)).otherwise(short)


def _macd_state(p: Column) -> Column:
    def dif(k):
        return p[f"dif{k}"] if k else p["fast"] - p["slow"]

    def dea(k):
        return p[f"dea{k}"] if k else p["dea"]

    def hist(k):
        return F.lit(2.0) * (dif(k) - dea(k))

    slope = (dif(0) > dif(1)) & (dea(0) >= dea(1))
    state = (
        F.when((hist(0) > 0) & (hist(1) <= 0) & slope, F.lit("red_turn"))
        .when((hist(0) > 0) & (hist(0) > hist(1)) & slope, F.lit("red_expanding"))
        .when((hist(0) <= 0) & (hist(0) > hist(1)) & (hist(1) > hist(2)) & (dif(0) > dif(1)), F.lit("green_contracting"))
        .when(hist(0) > 0, F.lit("red_weakening"))
        .otherwise(F.lit("green_or_weak"))
    )
    return F.struct(
        F.round(dif(0), 6).alias("dif"),
        F.round(dea(0), 6).alias("dea"),
        F.round(hist(0), 6).alias("histogram"),
        F.round(hist(1), 6).alias("previous_histogram"),
        state.alias("state"),
        slope.alias("slope_up"),
    )
