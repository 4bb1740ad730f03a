"""Scalar rules against hand-written expectations."""

import math

from pyspark.sql import functions as F

from tapeline.functions import codes, hashing, numbers, text, times


def rows(spark, data, cols):
    return spark.createDataFrame(data, cols)


def values(df, col="v"):
    return [r[col] for r in df.collect()]


def test_number_rules_differ_as_documented(spark):
    df = rows(spark, [("1.5",), ("-",), ("",), (None,), ("1d",), ("1,000",), (" 2 ",), ("inf",), ("nan",)], "x string").coalesce(1)
    assert values(df.select(numbers.num0("x").alias("v")))[:7] == [1.5, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0]
    strict = values(df.select(numbers.num_null_finite("x").alias("v")))
    assert strict == [1.5, None, None, None, None, None, 2.0, None, None]
    kept = values(df.select(numbers.num_null("x").alias("v")))
    assert kept[7] == math.inf and math.isnan(kept[8])


def test_zero_falls_through_or_else(spark):
    df = rows(spark, [(0.0, 3.0), (None, 4.0), (5.0, 6.0)], "a double, b double").coalesce(1)
    assert values(df.select(numbers.or_else("a", "b").alias("v"))) == [3.0, 4.0, 5.0]
    assert values(df.select(numbers.in_range("a", 0, 9).alias("v"))) == [True, False, True]


def test_source_time_rules(spark):
    data = [
        ("2026-06-18T00:41:40Z", "cls", "2026-06-18 08:41:40", "cls_z_as_utc"),
        ("2026-06-18T08:39:00Z", "eastmoney_global", "2026-06-18 08:39:00", "eastmoney_global_z_as_beijing_local"),
        ("2026-06-17T16:00:00Z", "cninfo", "2026-06-18 00:00:00", "cninfo_z_as_utc"),
        ("2026-06-17T15:00:00Z", "cninfo", "2026-06-17 15:00:00", "cninfo_z_as_beijing_local"),
        ("2026/06/18 09:05", "ndrc", "2026-06-18 09:05:00", "naive_as_beijing"),
        ("2026-6-8 9:05:01", "ndrc", "2026-06-08 09:05:01", "parsed_%Y-%m-%d %H:%M:%S_as_beijing"),
        ("2026-06-18T01:00:00+00:00", "ndrc", "2026-06-18 09:00:00", "timezone_converted_to_beijing"),
        ("2026-06-18T01:00:00-0530", "ndrc", "2026-06-18 14:30:00", "timezone_converted_to_beijing"),
        ("soon", "cls", None, "unparsed_publish_time"),
        ("", "cls", None, "missing_publish_time"),
    ]
    df = rows(spark, data, "t string, s string, want string, note string")
    out = df.withColumn("p", times.publish_time("t", "s")).select("t", times.ntz_text("p.ts").alias("got"), "want", "p.note", F.col("note").alias("n2"))
    for r in out.collect():
        assert (r.got, r.note) == (r.want, r.n2), r.t


def test_latency_is_fifteen_minutes_and_normal(spark):
    df = rows(spark, [("2026-06-18T00:40:00Z", "2026-06-18T08:55:00+08:00")], "p string, c string")
    p, c = times.publish_time("p", F.lit("cls"))["ts"], times.crawl_time("c")["ts"]
    r = df.select(times.latency_minutes(c, p).alias("m")).withColumn("l", times.latency_level("m")).first()
    assert (r.m, r.l) == (15.0, "normal")


def test_other_time_formats(spark):
    data = [("2026年06月18日 09:30", "2026-06-18T09:30:00Z"), ("1705305000", "2024-01-15T07:50:00Z"), ("1705305000000", "2024-01-15T07:50:00Z"),
            ("2026-06-18T09:30:00", "2026-06-18T09:30:00"), ("later", "later"), ("2026/6/8", "2026-06-08T00:00:00Z")]
    df = rows(spark, data, "t string, want string")
    for r in df.select(times.many_formats("t").alias("got"), "want").collect():
        assert r.got == r.want


def test_mode_windows(spark):
    data = [("morning", "2026-06-18 09:25:00", True), ("morning", "2026-06-18 08:44:00", False), ("overnight", "2026-06-18 14:50:00", True),
            ("overnight", "2026-06-18 23:08:00", False), ("custom", "2026-06-18 03:00:00", True)]
    df = rows(spark, data, "m string, t string, want boolean").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert all(r.got == r.want for r in df.select(times.mode_window_valid("m", "t").alias("got"), "want").collect())


def test_codes_and_names(spark):
    df = rows(spark, [("SH600000", "*ST Ａbc"), ("300001", "退市X"), ("920001", "ok"), ("12", "fine")], "c string, n string").coalesce(1)
    assert values(df.select(codes.clean_code("c").alias("v"))) == ["600000", "300001", "920001", "12"]
    assert values(df.select(codes.is_st_or_delisting("n").alias("v"))) == [True, True, False, False]
    assert values(df.select(codes.valid_code("c").alias("v"))) == [None, "300001", "920001", "000012"]
    assert values(df.select(codes.normalized_name("n").alias("v")))[0] == "bc"
    assert values(df.select(codes.is_restricted_code("c", True).alias("v"))) == [False, False, True, False]


def test_text_rules(spark):
    broken = "中文".encode().decode("latin1")
    df = rows(spark, [(broken,), ("plain",), ("Âx",)], "t string").coalesce(1)
    assert values(df.select(text.repair_mojibake("t").alias("v"))) == ["中文", "plain", "Âx"]
    df = rows(spark, [("买 600519 和 000001，非 1234567 与 688001x",)], "t string")
    assert values(df.select(text.stock_codes("t").alias("v"))) == [["000001", "600519", "688001"]]
    df = rows(spark, [('["a"," b ",""]',), ("a; b,,c",), (None,)], "t string").coalesce(1)
    assert values(df.select(text.split_list("t", ",;").alias("v"))) == [["a", "b"], ["a", "b", "c"], []]


def test_ids_have_their_published_form(spark):
    df = rows(spark, [("cls", "", "t", "2026-06-18 09:00:00", "u")], "source string, stock_code string, title string, publish_time string, url string")
    import hashlib

    want = hashlib.sha256("cls||t|2026-06-18 09:00:00|u".encode()).hexdigest()[:24]
    assert df.select(hashing.item_id().alias("v")).first().v == want
    raw = "overnight|2026-06-17T14:50:00+08:00"
    want = "20260617T145000_overnight_" + hashlib.sha256(raw.encode()).hexdigest()[:10]
    one = spark.range(1).select(hashing.snapshot_id(F.lit("overnight"), F.lit("2026-06-17T14:50:00+08:00")).alias("v"))
    assert one.first().v == want


def test_texts_are_searched_once_for_plates(spark, sf_dir):
    from tapeline.queries import all_queries
    from tapeline.queries.news import PLATES

    plan = all_queries()["a07_plate_distribution"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("length(replace(") == len({w for words in PLATES.values() for w in words})
