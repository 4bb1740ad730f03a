"""Pin scan against a plain Python evaluation of the same rules."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tapeline.functions.folds import ema, ema_last, macd
from tapeline.operators import pins


def test_macd_states(spark):
    series = {"up": [10 + 0.2 * i for i in range(20)], "v": [10, 9.8, 9.6, 9.4, 9.2, 9.0, 8.8, 8.7, 8.6, 8.6, 8.7, 8.9, 9.2, 9.6, 10.0, 10.5, 11.0], "short": [1.0] * 11}
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in series.items()], "k string, c array<double>")
    got = {r.k: r for r in df.select("k", macd(F.col("c")).alias("m"), ema(F.col("c"), 12).alias("e")).collect()}
    assert got["short"].m.state == "insufficient_history" and got["short"].m.dif is None
    assert got["v"].m.state in {"red_turn", "red_expanding", "green_contracting"}
    value, alpha = series["v"][0], 2 / 13
    for i, x in enumerate(series["v"]):
        value = x if i == 0 else alpha * x + (1 - alpha) * value
        assert abs(got["v"].e[i] - value) < 1e-12


def series(n=22, seed=1):
    rng, price, out = random.Random(seed), 20.0, []
    for i in range(n):
        prev, price = price, price * (1 - 0.004 + rng.uniform(-0.01, 0.01))
        out.append([prev, prev * 1.01, price * 0.99, price, prev, 6e7])
    return out


def as_bars(spark, rows, code="600001"):
    data = [
        (code, "Name", date(2026, 5, 1) + timedelta(days=i), i + 1, o, max(h, o, c), min(l, o, c), c, p, (c / p - 1) * 100, a)
        for i, (o, h, l, c, p, a) in enumerate(rows)
    ]
    return spark.createDataFrame(data, "code string, name string, session date, session_no int, open double, high double, low double, close double, prev_close double, pct double, amount double")


def test_long_lower_shadow_then_breakout(spark):
    rows = series()
    prev = rows[-1][3]
    low = min(r[2] for r in rows) * 0.985
    rows.append([prev * 0.99, prev * 1.001, low, prev * 1.0, prev, 6e7])
    pin_close = rows[-1][3]
    rows.append([pin_close * 1.005, pin_close * 1.05, pin_close, pin_close * 1.04, pin_close, 9e7])
    got = pins.evaluate_series(pins.series_panel(as_bars(spark, rows))).where(f"session_no = {len(rows)}").first()
    assert got.pattern_date == date(2026, 5, 1) + timedelta(days=len(rows) - 2)
    assert got.days_since_pin == 1 and got.shape_pass and got.breakout_confirmation and got.macd_confirmed


def test_high_position_is_rejected(spark):
    rows = [[10.0 + i, 10.8 + i, 9.9 + i, 10.7 + i, 9.7 + i, 6e7] for i in range(20)]
    rows.append([30.5, 30.9, 28.5, 30.8, 29.7, 6e7])
    got = pins.evaluate_series(pins.series_panel(as_bars(spark, rows))).where(f"session_no = {len(rows)}").first()
    assert got.lower_shadow_ratio > 0.28 and not got.shape_pass


def test_live_bar_keeps_only_the_same_pattern(spark):
    rows = series()
    prev = rows[-1][3]
    rows.append([prev * 0.99, prev * 1.001, min(r[2] for r in rows) * 0.985, prev, prev, 6e7])
    base = pins.evaluate_series(pins.series_at(as_bars(spark, rows), F.lit(len(rows)))).where("shape_pass")
    live = as_bars(spark, [[prev * 1.005, prev * 1.05, prev, prev * 1.04, prev, 9e7]]).withColumn("session", F.lit(date(2026, 7, 1)))
    out = pins.with_live_bar(base, live).first()
    assert out.live_breakout_confirmation and out.live_confirmation_score > out.objective_score
    lists = {r["list"] for r in pins.scan_lists(pins.with_live_bar(base, live).withColumn("session", F.lit(1))).collect()}
    assert "live_breakouts" in lists


def test_series_at_equals_panel(spark):
    bars = as_bars(spark, series(40, 7))
    at = pins.evaluate_series(pins.series_at(bars, F.lit(40))).drop("obs").collect()
    panel = pins.evaluate_series(pins.series_panel(bars)).where("session_no = 40").drop("obs", "session", "session_no").collect()
    assert [r.asDict() for r in at] == [r.asDict() for r in panel]


def test_series_are_collected_once(spark, sf_dir):
    from tapeline.queries import all_queries

    for name in ("k03_pin_lists", "k03_live_lists", "k03_list_counts", "j14_live_confirmation"):
        plan = all_queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("collect_list(") == 1, name


def test_last_average_and_macd_by_their_definition(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(5, 50) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 11, 12, 13, 35, 36])]
    df = spark.createDataFrame(rows, "i int, c array<double>")
    for r in df.select("c", ema_last(F.col("c"), 12).alias("last"), macd(F.col("c")).alias("m")).collect():
        def average(values, span):
            out = list(values[:1])
            for x in values[1:]:
                out.append((2.0 / (span + 1)) * x + (1 - 2.0 / (span + 1)) * out[-1])
            return out

        fast, dif = average(r.c, 12), [a - b for a, b in zip(average(r.c, 12), average(r.c, 26))]
        assert r.last == (fast[-1] if fast else None)
        if len(r.c) >= 12:
            hist = [2.0 * (a - b) for a, b in zip(dif, average(dif, 9))]
            assert abs(r.m.dif - dif[-1]) <= 5e-7 and abs(r.m.histogram - hist[-1]) <= 5e-7 and abs(r.m.previous_histogram - hist[-2]) <= 5e-7
