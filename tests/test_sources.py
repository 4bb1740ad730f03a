"""Decoders, HTML and stores."""

import json

from pyspark.sql import functions as F

from tapeline.operators.archive import merge_indexes
from tapeline.session import work_path
from tapeline.sources import decoders as E
from tapeline.sources import html as H
from tapeline.sources import stores as S


def test_comma_kline_previous_close(spark):
    doc = {"data": {"code": "1", "name": "x", "klines": ["2026-06-17,10.0,10.20,10.4,9.9,1234,456789,5,2.0,0.20,1.1", "2026-06-18,1,2,3"]}}
    r = E.decode_klines(spark.createDataFrame([("1", "x", json.dumps(doc))], "code string, name string, payload string")).collect()
    assert len(r) == 1 and r[0].prev_close == 10.0 and r[0].amount == 456789.0 and r[0].code == "000001"


def test_array_kline_carries_the_close(spark):
    doc = {"data": {"sz000001": {"qfqday": [["2026-06-17", "10", "10.10", "10.2", "9.9", "100"], ["2026-06-18", "10", "-", "10.2", "9.9", "100"], ["2026-06-19", "10.1", "10.30", "10.4", "10", "120"]]}}}
    r = E.decode_array_klines(spark.createDataFrame([("000001", "x", json.dumps(doc))], "code string, name string, payload string")).orderBy("session").collect()
    assert r[0].prev_close is None and r[1].close is None and r[2].prev_close == 10.1


def test_roll_news_fields(spark):
    doc = {"data": {"items": [{"brief": "b", "ctime": 1705305000, "tags": "x, y", "plate": ["AI", " 半导体 "], "content": "c"}, {"level": "A"}]}}
    r = E.decode_roll_news(spark.createDataFrame([(json.dumps(doc),)], "response string"), category="t").collect()
    assert len(r) == 1
    assert (r[0].title, r[0].tags, r[0].plate, r[0].publish_time) == ("b", ["x", "y", "t"], ["AI", "半导体"], "2024-01-15T07:50:00Z")


def test_list_and_detail_pages(spark):
    listing = "<html><body><a href='./202601/t20260101_1.html'>a</a><a href='/about/'>b</a><a href='https://other.cn/t2026.html'>c</a></body></html>"
    detail = (
        "<html><head><meta name='ArticleTitle' content='T'><meta name='PubDate' content='2026/01/05 10:00'></head><body><div class='article'><p>one <b>two</b></p>"
        "<p>three</p></div><div class='tags'><a>k</a></div><script>var p='<p>no</p>'</script></body></html>"
    )
    pages = spark.createDataFrame([(1, "https://www.ndrc.gov.cn/xw/", listing), (2, "https://www.ndrc.gov.cn/x", detail)], "page_id bigint, url string, html string")
    parsed = H.parse_pages(pages)
    assert [r.link for r in H.article_links(parsed).where("page_id = 1").collect()] == ["https://www.ndrc.gov.cn/xw/202601/t20260101_1.html"]
    r = H.articles(parsed).where("page_id = 2").first()
    assert (r.title, r.publish_time, r.content, r.tags) == ("T", "2026-01-05T10:00:00Z", "one two three", ["k"])


def test_listed_items(spark):
    page = "<div class='news-item'><h3>t</h3><span class='time'>2026-01-05 10:00</span><p class='content'>c1</p><p class='content'>c2</p><span class='tag'>g</span></div><div class='news-item'><p class='content'>untitled</p></div>"
    r = H.listed_items(H.parse_pages(spark.createDataFrame([(1, "u", page)], "page_id bigint, url string, html string")), "cat").collect()
    assert len(r) == 1 and (r[0].title, r[0].content, r[0].tags) == ("t", "c1 c2", ["g", "cat"])


def test_news_files_take_source_and_date_from_the_path(spark):
    import os

    base = work_path(spark, "files")
    os.makedirs(f"{base}/cls")
    with open(f"{base}/cls/2026-06-18.json", "w", encoding="utf-8") as f:
        json.dump([{"title": "a", "source_urls": ["u"]}, {"title": "b", "source": "other"}], f)
    got = sorted((r.title, r.source, r.file_date) for r in S.read_news_files(spark, base).collect())
    assert got == [("a", "cls", "2026-06-18"), ("b", "other", "2026-06-18")]


def test_saving_twice_changes_nothing(spark, sf_dir):
    from tapeline.queries.news import normalized

    store = work_path(spark, "store")
    batch = normalized(spark, sf_dir).withColumn("arrival", F.col("doc_id"))
    read = lambda: sorted((r.item_key, r.doc_id, r.collected_at) for r in spark.read.parquet(store).collect())
    S.save_news(spark, batch, store, work_path(spark, "staging"))
    first = read()
    S.save_news(spark, batch, store, work_path(spark, "staging"))
    assert read() == first


def test_later_payload_wins_and_old_dates_are_pruned(spark):
    schema = "id string, title string, publish_time string"
    one = spark.createDataFrame([("i", "old", "2026-06-18 09:00"), ("o", "x", "2026-01-01 09:00")], schema)
    two = spark.createDataFrame([("i", "new", "2026-06-18 09:00"), ("", "made", "2026-06-18 10:00")], schema)
    got = {r.title: r.id for r in merge_indexes([one, two], "2026-06-04", "2026-06-18").collect()}
    assert got["new"] == "i" and set(got) == {"new", "made"} and len(got["made"]) == 24


def test_bucketed_bars_need_no_shuffle(spark, sf_dir):
    from tapeline.operators.features import objective_features
    from tapeline.sources.driver_tables import bars

    S.save_bars_table(bars(spark, sf_dir), "bars_bucketed_test", 4)
    plan = objective_features(spark.table("bars_bucketed_test")).select("code", "ma5")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    spark.sql("DROP TABLE bars_bucketed_test")


def test_keyset_page_continues_the_offset_page(spark, sf_dir):
    from tapeline.operators.news import newest_first, page, page_after, with_item_id
    from tapeline.queries.news import normalized

    items = with_item_id(normalized(spark, sf_dir)).select("id", "doc_id", "publish_time", "publish_time_bj")
    first = page(items, newest_first(items), 0, 40).collect()
    second = page(items, newest_first(items), 40, 20).collect()
    last = first[-1]
    keyed = page_after(items, [("publish_time_bj", True), ("id", False)], [last.publish_time_bj, last.id], 20).collect()
    assert [r.doc_id for r in keyed] == [r.doc_id for r in second]


def test_codes_beyond_six_places_are_not_cut(spark):
    rows = [(c, "x", json.dumps({"data": {"code": c, "name": "x", "klines": ["2026-06-17,10.0,10.20,10.4,9.9,1234,456789,5,2.0,0.20,1.1"]}})) for c in ("0003220", "0003221", "12")]
    got = E.decode_klines(spark.createDataFrame(rows, "code string, name string, payload string")).collect()
    assert sorted(r.code for r in got) == ["000012", "0003220", "0003221"]


def test_references_end_in_a_semicolon(spark):
    page = "<body><div class='article'><h1>a&amp;&lt;b&gt; c&amp</h1><p>x &amp; y&am &#38; &#38 &nosuch; &eacute;</p><a href='/q?a=1&amp;b=2&copy=3'>k</a></div></body>"
    parsed = H.parse_pages(spark.createDataFrame([(1, "u", page)], "page_id bigint, url string, html string"))
    r = H.articles(parsed).first()
    assert (r.title, r.content) == ("a&<b> c&amp", "x & y&am & &#38 &nosuch; é")
    assert parsed.first().hrefs == ["/q?a=1&b=2&copy=3"]


def test_parts_of_pages_that_are_not_asked_for_are_left_out(spark):
    page = "<html><title>t</title><a href=' x '>k</a><article><p>long</p></article></html>"
    pages = spark.createDataFrame([(i, "u", page) for i in range(5)] + [(5, "u", None)], "page_id bigint, url string, html string")
    got = H.parse_pages(pages, parts=("hrefs",), batch_chars=100)
    assert got.columns == ["page_id", "url", "hrefs"]
    assert sorted((r.page_id, r.hrefs) for r in got.collect()) == [(i, ["x"]) for i in range(5)] + [(5, [])]


def test_news_days_lie_in_month_folders_and_expire_one_by_one(spark):
    import os

    days = ["2025-12-31", "2026-01-01", "2026-01-09", "2026-01-10", "2026-01-31", "2026-02-01"]
    rows = [(s, d, i) for i, d in enumerate(days) for s in ("a", "b") if not (s == "b" and d[:7] == "2026-01" and d > "2026-01-05")]
    store = work_path(spark, "months")
    S.write_news_store(spark.createDataFrame(rows, "source string, publish_date_bj string, n int"), store)
    assert sorted(x for x in os.listdir(f"{store}/source=a") if "=" in x) == [f"publish_month={m}" for m in ("2025-12", "2026-01", "2026-02")]
    assert {r.publish_date_bj for r in S.read_news_store(spark, store, "a", "2026-01-01", "2026-01-10").collect()} == set(days[1:4])
    assert S.drop_expired(spark, store, "2026-01-25", 15) == days[:3]
    left = sorted((r.source, r.publish_date_bj) for r in S.read_news_store(spark, store).collect())
    assert left == [("a", d) for d in days[3:]] + [("b", days[5])]
    assert S.drop_expired(spark, store, "2026-01-25", 15) == []


def test_index_days_of_one_month_are_replaced_one_by_one(spark):
    path, schema = work_path(spark, "index"), "id string, market_date string, dataset_version string, title string"
    S.write_index_archive(spark.createDataFrame([("x", "2026-01-01", "v", "old"), ("y", "2026-01-02", "v", "old"), ("w", "2026-01-02", "u", "old")], schema), path)
    S.write_index_archive(spark.createDataFrame([("z", "2026-01-02", "v", "new")], schema), path)
    assert sorted((r.id, r.title) for r in S.read_index_archive(spark, path, "2026-01-01", "2026-01-31").collect()) == [("w", "old"), ("x", "old"), ("z", "new")]
