"""Journal, collectors, calendar and news state."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tapeline.operators import calendar as K
from tapeline.operators import collectors as L
from tapeline.operators import journal as J
from tapeline.operators import news as N


def dates(spark, *values):
    return spark.createDataFrame([(date.fromisoformat(v),) for v in values], "date date")


def june(spark):
    closed = dates(spark, "2026-06-19")
    return K.calendar_dim(dates(spark, "2026-06-01"), F.lit(date(2026, 5, 1)), F.lit(date(2026, 7, 31)), closed, None, (2026,))


def test_holiday_and_neighbours(spark):
    dim = june(spark)
    got = {r.date: r for r in dim.collect()}
    assert not got[date(2026, 6, 19)].is_trade_day and not got[date(2026, 6, 20)].is_trade_day
    assert got[date(2026, 6, 18)].next_trade_day == date(2026, 6, 22)
    assert got[date(2026, 6, 22)].previous_trade_day == date(2026, 6, 18)


def test_completed_days_wait_for_the_close(spark):
    dim = june(spark)
    day = lambda now: [r.date.day for r in K.completed_trade_days(dim, now, 3).orderBy("date").collect()]
    assert day("2026-06-22 14:30:00") == [16, 17, 18]
    assert day("2026-06-22 15:20:00") == [17, 18, 22]


def test_next_slot_rolls_over_the_holiday(spark):
    t = spark.createDataFrame([("2026-06-18 15:00:00",), ("2026-06-18 14:41:00",), ("2026-06-20 10:00:00",)], "now string").coalesce(1)
    t = t.withColumn("now", F.col("now").cast("timestamp_ntz"))
    got = sorted((str(r.now), str(r.run_date), r.slot) for r in K.next_slot(june(spark), t).collect())
    assert got == [("2026-06-18 14:41:00", "2026-06-18", "14:45"), ("2026-06-18 15:00:00", "2026-06-22", "09:15"), ("2026-06-20 10:00:00", "2026-06-22", "09:15")]


def test_backoff_doubles_and_resets(spark):
    log = [("s", datetime(2026, 1, 1, 0, m), ok, None if ok else "boom", 60) for m, ok in enumerate([False, False, True, False])]
    df = spark.createDataFrame(log, "source string, ts timestamp, ok boolean, error string, base_interval int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = [(r.consecutive_failures, r.backoff) for r in L.failure_streaks(df).orderBy("ts").collect()]
    assert got == [(1, 120), (2, 240), (0, None), (1, 120)]
    state = L.collector_state(df).first()
    assert state.consecutive_failures == 1 and state.last_error == "boom"


def test_second_run_supersedes_the_first(spark):
    runs = spark.createDataFrame([(date(2026, 6, 18), "morning", 1, "r1", "x"), (date(2026, 6, 18), "morning", 2, "r2", "y")], "trade_date date, mode string, recorded_at bigint, run_id string, judgment string")
    got = {r.run_id: r for r in J.versioned(runs).collect()}
    assert got["r1"].status == "superseded" and got["r1"].superseded_by == "r2" and got["r2"].status == "active"
    assert got["r1"].content_sha256 != got["r2"].content_sha256


def test_review_never_substitutes_an_older_run(spark):
    d17, d18, d16 = date(2026, 6, 17), date(2026, 6, 18), date(2026, 6, 16)
    schema = "trade_date date, mode string, recorded_at bigint, run_id string"
    runs = spark.createDataFrame([(d17, "overnight", 1, "o17"), (d18, "morning", 2, "m18"), (d18, "overnight", 3, "o18")], schema)
    want = dates(spark, "2026-06-18")
    r = J.review_context(runs, want).first()
    assert (r.morning, r.previous_overnight, r.pending_overnight, r.previous_source) == ("m18", "o17", "o18", "journal_fallback")
    old = spark.createDataFrame([(d16, "overnight", 1, "o16"), (d18, "morning", 2, "m18")], schema)
    r = J.review_context(old, want, dates(spark, "2026-06-16", "2026-06-17")).first()
    assert r.previous_date == d17 and r.previous_overnight is None


def test_risk_title_scores_high(spark):
    item = [("cninfo", "关于股东减持股份及股票交易异常波动的公告", "2026-06-18 09:00:00", "000001")]
    df = spark.createDataFrame(item, "source string, title string, publish_time string, stock_code string")
    r = N.enrich_news(N.normalize_news(df, F.lit("2026-06-18 09:10:00").cast("timestamp_ntz"))).first()
    assert r.risk_level == "high" and {"share_reduction", "abnormal_volatility"} <= set(r.risk_flags) and r.news_score >= 75
    policy = spark.createDataFrame([("ndrc", "国家发展改革委发布数据中心政策通知", "2026-06-18 09:00:00")], "source string, title string, publish_time string")
    r = N.enrich_news(N.normalize_news(policy)).first()
    assert r.news_tier == "policy" and r.news_score >= 70 and r.is_high_impact


def test_merge_keeps_first_fields_all_urls_and_earliest_time(spark):
    rows = [(2, "cls", "2026-06-18", "u", "b", ["u", "v"], "2026-06-18T09:05:00+08:00"), (1, "cls", "2026-06-18", "u", "a", ["u"], "2026-06-18T09:10:00+08:00"),
            (3, "cls", "2026-06-18", "u", "c", ["w"], "2026-06-18T09:20:00+08:00")]
    df = spark.createDataFrame(rows, "arrival bigint, source string, publish_date_bj string, url string, title string, source_urls array<string>, collected_at string")
    df = df.withColumns({"stock_code": F.lit(""), "publish_time": F.lit("t"), "crawled_at": F.col("collected_at")})
    r = N.merge_duplicates(df, "arrival").first()
    assert (r.title, r.source_urls, r.collected_at, r.n_copies) == ("a", ["u", "v", "w"], "2026-06-18T09:05:00+08:00", 3)


def test_focus_codes_of_seven_places_count_by_their_first_six(spark):
    runs = spark.createDataFrame([("r", "overnight"), ("q", "overnight")], "run_id string, mode string")
    cands = spark.createDataFrame([("r", 1, "100000", "n"), ("q", 1, "1000007", "n")], "run_id string, rank int, code string, name string")
    focus = spark.createDataFrame([("r", "1000007"), ("q", "1000007")], "run_id string, code string")
    got = {(r.run_id, r.violation) for r in J.violations(runs, cands, focus).collect()}
    assert ("q", "focus code not a candidate") in got and ("r", "focus code not a candidate") not in got and ("q", "invalid code") in got


def test_j16_matches_its_sql_beyond_six_places(spark, sf_dir, tmp_path):
    from tapeline.queries import all_checks, all_queries
    from tests.compare import connect, differences

    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("l_partkey", F.col("l_partkey") + 999_900)
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    duck = connect(sf_dir)
    duck.execute(f"CREATE OR REPLACE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("c15_journal_violations", "j16_focus_in_candidates"):
        assert not differences(all_queries()[name](spark, str(tmp_path)), all_checks()[name], duck), name


def test_attempts_of_one_moment_count_together(spark):
    """As sums over peers of an order by time do: a success ends the streak at its moment, whose own failures stay."""
    plan = [(0, "f"), (1, "ff"), (2, "fs"), (3, "f"), (4, "ssf"), (5, "s"), (6, "ff")]
    log = [("s", datetime(2026, 1, 1, 0, m), k == "s", "boom", 60) for m, kinds in plan for k in kinds]
    df = spark.createDataFrame(log, "source string, ts timestamp, ok boolean, error string, base_interval int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {(r.ts.minute, r.ok, r.consecutive_failures) for r in L.failure_streaks(df, together=True).collect()}
    assert {(m, n) for m, _, n in got} == {(0, 1), (1, 3), (2, 1), (3, 2), (4, 1), (5, 0), (6, 2)}
    assert L.failure_streaks(df, together=True).count() == len(log)
    assert L.collector_state(df.where(F.minute("ts") < 5)).first().consecutive_failures == 1
