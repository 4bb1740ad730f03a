"""Two-level building blocks against brute force, with one key holding most rows."""

import bisect
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tapeline.operators import scaling as S


def test_percentile_rank_equals_bisect_with_hot_value_and_nulls(spark):
    rng = random.Random(3)
    data = [(g, i, None if i % 11 == 0 else (1.0 if i % 3 == 0 else rng.uniform(-1e4, 1e4) * 10 ** rng.randint(-6, 3))) for g in ("a", "b") for i in range(400 if g == "a" else 30)]
    data += [("b", 900, 0.0), ("b", 901, -0.0), ("b", 902, 2.0 ** 40), ("b", 903, 2.0 ** 40 - 2 ** -12)]
    df = spark.createDataFrame(data, "g string, i int, v double")
    got = {(r.g, r.i): r.rank for r in S.percentile_rank(df, ["g"], "v", "rank").collect()}
    for g, i, v in data:
        vals = sorted(x for h, _, x in data if h == g and x is not None)
        want = None if v is None else bisect.bisect_right(vals, v) / len(vals)
        assert got[(g, i)] == want
    multi = S.percentile_ranks(df, ["g"], ["i"], [("v", "up", False), ("v", "down", True)])
    for r in multi.collect():
        assert r.up == got[(r.g, r.i)] and (r.v is None or r.down == 1.0 - r.up)


def events(spark, n=500):
    rng = random.Random(5)
    start, data = datetime(2024, 1, 1), []
    for i in range(n):
        start += timedelta(seconds=rng.randint(1, 900))
        data.append(("hot" if rng.random() < 0.8 else "cold", start, rng.randint(-5, 9)))
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, x int")
    return df.repartition(4), data


def test_ordered_totals_and_extremes(spark):
    df, data = events(spark)
    out = S.ordered_totals(df, ["k"], S.time_bucket(F.col("ts")), ["ts"], {"total": F.col("x")})
    out = S.ordered_extreme(out, ["k"], S.time_bucket(F.col("ts")), ["ts"], F.col("total"), "low", largest=False)
    got = {(r.k, r.ts): (r.total, r.low) for r in out.collect()}
    for k in ("hot", "cold"):
        total, low = 0, None
        for key, ts, x in data:
            if key == k:
                total += x
                low = total if low is None else min(low, total)
                assert got[(k, ts)] == (total, low)


def test_neighbours(spark):
    df, data = events(spark)
    got = {(r.k, r.ts): (r.prev_x, r.first_x) for r in S.neighbours(df, ["k"], S.time_bucket(F.col("ts")), "ts", ["x"]).collect()}
    for k in ("hot", "cold"):
        prev = first = None
        for key, ts, x in data:
            if key == k:
                first = x if first is None else first
                assert got[(k, ts)] == (prev, first)
                prev = x


def test_top_n_limits_before_the_shuffle(spark):
    df, _ = events(spark)
    plan = S.top_n(df, ["k"], [F.desc("x"), F.asc("ts")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
