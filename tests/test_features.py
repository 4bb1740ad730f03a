"""Features: golden cases, brute force and the no-look-ahead property."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from tapeline.operators import features as X
from tapeline.plans import replay as P
from tapeline.sources import driver_tables as D

SCHEMA = "code string, name string, session date, session_no int, open double, high double, low double, close double, prev_close double, pct double, amount double, volume double, turnover double, volume_ratio double, amplitude double"


def bars(spark, closes, code="600001"):
    data = [
        (code, "Name", date(2026, 6, 1) + timedelta(days=i), i + 1, c - 0.1, c + 0.5, c - 0.5, float(c), float(closes[i - 1] if i else c - 1.0), 1.0, 1e8 + i, 1e6 + i, 1.0, 1.0, 2.0)
        for i, c in enumerate(closes)
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_twenty_sessions(spark):
    out = X.objective_features(bars(spark, [10.0 + d for d in range(20)])).orderBy("session").collect()[-1]
    assert out.history_points == 20
    assert out.ma20 == 19.5 and out.ma5 == 27.0
    assert out.return_15d == round((29 / 14 - 1) * 100, 4)
    assert out.atr14 is not None and len(out.recent_high_series) == 15 == len(out.history_dates)
    assert out.consecutive_amount_increases == 19


def test_missing_values_follow_the_zero_rule(spark):
    b = bars(spark, [10.0, 11.0, 12.0, 13.0]).withColumns({"volume": F.lit(None).cast("double"), "high": F.lit(None).cast("double")})
    r = X.objective_features(b).orderBy(F.desc("session")).first()
    assert r.volume == 0.0
    assert r.upper_shadow_ratio is None and r.ma5 is None and r.atr14 is None and r.average_volume_5d is None


def test_future_rows_never_change_earlier_features(spark):
    closes = [10, 11, 10.5, 12, 13, 12.5, 13.5, 14, 13, 15, 16, 15.5, 17, 16, 18]
    short, long = bars(spark, closes[:12]), bars(spark, closes)
    for build in (X.objective_features, X.replay_features):
        a = build(short).drop("next_session_no").orderBy("session").collect()
        b = build(long).drop("next_session_no").where("session_no <= 12").orderBy("session").collect()
        assert a == b


def test_history_is_bounded_by_market_sessions(spark):
    b = bars(spark, [10.0 + d for d in range(30)]).where("session_no % 10 in (0, 1)")
    r = X.objective_features(b).where("session_no = 30").first()
    # Sessions 6..30 are visible: 10, 11, 20, 21, 30.
    assert r.history_points == 5


def test_suspended_code_keeps_its_last_row(spark, sf_dir):
    b = bars(spark, [10.0 + d / 10 for d in range(12)]).unionByName(bars(spark, [20.0 + d / 10 for d in range(15)], "600002"))
    panel = P.ranked_panel(b)
    got = {(r.as_of_no, r.code): r.session_no for r in panel.collect()}
    assert got[(15, "600001")] == 12 and got[(15, "600002")] == 15


def test_replay_is_clean_and_audit_finds_tampering(spark, sf_dir):
    signals = P.generate_signals(D.bars(spark, sf_dir), D.messages(spark, sf_dir), positive=("tion",), risk=("zz",))
    sealed = P.sealed(signals.picks)
    maxima = P.visible_maxima(D.messages(spark, sf_dir), signals.decisions)
    assert maxima.count() > 0 and P.leakage_audit(signals.decisions, maxima, sealed).count() == 0
    forged = sealed.withColumn("score", F.col("score") + 1)
    assert P.leakage_audit(signals.decisions, maxima, forged).where("violation = 'seal mismatch'").count() == sealed.count()
    early = signals.decisions.withColumn("as_of_no", F.col("decision_no"))
    assert P.leakage_audit(early, maxima, sealed).where("violation = 'wrong market anchor'").count() > 0
    late = maxima.withColumn("latest", F.col("latest") + F.expr("INTERVAL 9 DAYS"))
    assert P.leakage_audit(signals.decisions, late, sealed).where("violation = 'future message'").count() == maxima.count()
