"""Stored state is the same however rows are dealt to batches."""

import pickle
import random
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
from pyspark.sql import functions as F

from tapeline.operators.collectors import collector_state, failure_streaks
from tapeline.operators.intraday import intraday_changes, stock_daily
from tapeline.operators.ledger import holdings
from tapeline.session import work_path
from tapeline.sources import stores
from tapeline.streaming import news as S
from tapeline.streaming import state as T

START = datetime(2026, 1, 1)


def stream(spark, rows, schema, files, seed=1):
    """A shuffled JSON landing folder of so many files, one per trigger."""
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    path = work_path(spark, "landing")
    for k in range(files):
        spark.createDataFrame(rows[k::files], schema).coalesce(1).write.mode("append").json(path)
    return S.landing_stream(spark, path, schema, 1)


def log_rows():
    rng = random.Random(3)
    return [(rng.choice("aab"), START + timedelta(minutes=5 * (i // 2)), rng.random() < 0.3, f"e{i}", 60) for i in range(120)]


LOG = "source string, ts timestamp, ok boolean, error string, base_interval int"


def test_collector_health(spark):
    rows = [(s, t + timedelta(seconds=i), ok, None if ok else e, b) for i, (s, t, ok, e, b) in enumerate(log_rows())]
    whole = {tuple(r) for r in collector_state(spark.createDataFrame(rows, LOG).withColumn("ts", F.col("ts").cast("timestamp_ntz"))).collect()}
    for files in (1, 5):
        store = work_path(spark, "health")
        T.keep_collector_health(spark, stream(spark, rows, LOG, files), store, work_path(spark, "cp"))
        kept = T.latest_version(spark, store)
        assert kept.count() < len(rows)
        assert {tuple(r) for r in collector_state(kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))).collect()} == whole


TRADES = "account bigint, code string, name string, no bigint, side string, quantity bigint, price double, at timestamp"


def trade_rows(n, seed=4):
    rng = random.Random(seed)
    return [(1, rng.choice("xyyyz"), f"N{i % 3}", i, rng.choice(["buy", "buy", "sell", "upsert"]), rng.choice([None, *range(1, 9)]), rng.choice([None, *map(float, range(5, 50))]), START + timedelta(hours=i)) for i in range(n)]


def kept_holdings(spark, rows, files, **more):
    store = work_path(spark, "holdings")
    T.keep_holdings(stream(spark, rows, TRADES, files), [F.col("no")], store, work_path(spark, "cp"), **more)
    return store


def test_holdings(spark):
    rows = trade_rows(300)
    whole = spark.createDataFrame(rows, TRADES).withColumn("seq", F.struct("no")).withColumn("at", F.col("at").cast("timestamp_ntz"))
    fields = ("code", "name", "quantity", "average_cost", "trades", "rejected")
    want = {tuple(r[f] for f in fields) for r in holdings(whole).collect()}
    for files in (1, 5):
        held = T.present_holdings(spark, kept_holdings(spark, rows, files, delay="1000 days", chunk=8))
        assert {tuple(r[f] for f in fields) for r in held.collect()} == want


def test_stored_trades_come_back_and_take_less():
    rng = random.Random(6)
    trades = [((10**15 + 86_400_000_000 * i, rng.randrange(10**7), 1 + i % 7, None), "buy", None if i % 50 == 0 else i % 60, None if i % 70 == 0 else i / 7, "N", None if i % 90 == 0 else i) for i in range(256)]
    assert T.unpacked(T.packed(trades)) == trades and T.unpacked(T.packed(trades[:1])) == trades[:1]
    assert len(T.packed(trades)) < len(pickle.dumps(trades, 5)) / 2


def test_trades_land_whole_and_small(spark, sf_dir, monkeypatch):
    """The holdings' landing folder takes less than half of the same rows as JSON; its batches hold all trades, and each spans all times."""
    from tapeline.queries import streams as R

    folders, plain = {}, R.work_path
    monkeypatch.setattr(R, "work_path", lambda session, label: folders.setdefault(label, plain(session, label)))
    R.r07(spark, sf_dir)
    size = sum(p.stat().st_size for p in Path(folders["landing"]).rglob("part-*"))
    trades = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert size < 100 * trades.count()  # about 230 a row as JSON
    landed = spark.read.parquet(folders["landing"])
    key = ("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    assert landed.count() == trades.count() and landed.select(*key).exceptAll(trades.select(*key)).isEmpty()
    spans = landed.groupBy(F.input_file_name()).agg(F.min("at").alias("a"), F.max("at").alias("b")).collect()
    positions = spark.read.parquet(f"{folders['holdings']}/positions")
    assert {r.batch for r in positions.select("batch").distinct().collect()} == {0, 1, 2, 3}
    assert max(s.a for s in spans) < min(s.b for s in spans)


def test_a_late_trade_reads_its_chunk_and_what_it_moves(spark):
    """Positions are sold out again and again, so a late trade moves one chunk, not the log behind it."""
    sides = ["buy", "buy", "buy", "sell"]
    rows = [(1, "a", "N", 10 * i, sides[i % 4], None if i % 4 == 3 else 2, 5.0, START + timedelta(hours=i)) for i in range(400)]
    path = work_path(spark, "landing")
    for part in (rows, [(1, "a", "N", 1005, "buy", 2, 5.0, START + timedelta(hours=100))]):
        spark.createDataFrame(part, TRADES).coalesce(1).write.mode("append").json(path)
    store = work_path(spark, "late")
    T.keep_holdings(S.landing_stream(spark, path, TRADES, 1), [F.col("no")], store, work_path(spark, "cp"), delay="1000 days", chunk=8)
    read = {r.batch: r.replayed for r in spark.read.parquet(f"{store}/positions").collect()}
    assert read[0] == 0 and 0 < read[1] <= 3 * 8
    assert T.present_holdings(spark, store).first().trades == 401


def test_trades_the_watermark_has_passed_leave_the_state(spark):
    rows = [(1, "a", "N", i, "buy", 1, 5.0, START + timedelta(hours=i)) for i in range(200)]
    path = work_path(spark, "landing")
    for part in (rows[:150], rows[150:], [(1, "a", "N", -1, "sell", 1, 5.0, START), (1, "a", "N", 300, "buy", 1, 5.0, START + timedelta(hours=300))]):
        spark.createDataFrame(part, TRADES).coalesce(1).write.mode("append").json(path)
    store = work_path(spark, "passed")
    query = T.keep_holdings(S.landing_stream(spark, path, TRADES, 1), [F.col("no")], store, work_path(spark, "cp"), delay="10 hours", chunk=8)
    held = T.present_holdings(spark, store).first()
    assert held.late == 1 and held.quantity == 201 and held.trades == 201
    assert [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1] < 15


def test_intraday_with_equal_times(spark):
    rng = random.Random(5)
    rows = [(f"c{i % 3}", (START + timedelta(hours=7 * (i // 9))).date(), START + timedelta(hours=7 * (i // 9)), float(rng.randint(1, 90)), float(i)) for i in range(90)]
    schema = "code string, market_date date, captured_at timestamp, price double, amount double"
    want = sorted(map(tuple, intraday_changes(spark.createDataFrame(rows, schema)).collect()))
    for files in (1, 5):
        store = work_path(spark, "intraday")
        T.keep_intraday(spark, stream(spark, rows, schema, files), store, work_path(spark, "cp"))
        got = spark.read.parquet(f"{store}/changes").select("code", "market_date", "captured_at", "price", "amount", *[c for c in ("price_change_from_previous", "amount_change_from_previous", "price_change_from_first", "amount_change_from_first")])
        key = lambda r: (r[0], r[1], r[2], r[3], r[4], *[(x is None, x or 0) for x in r[5:]])
        assert sorted(map(key, map(tuple, got.collect()))) == sorted(map(key, want))


def test_days_that_expire_leave_the_store(spark):
    days = [START + timedelta(days=d, hours=10) for d in range(6)]
    path, schema = work_path(spark, "landing"), "code string, market_date date, captured_at timestamp, price double, amount double"
    for day in days:
        spark.createDataFrame([(c, day.date(), day + timedelta(minutes=m), float(m), 1.0) for c in "ab" for m in range(3)], schema).coalesce(1).write.mode("append").json(path)
    store = work_path(spark, "intraday")
    T.keep_intraday(spark, S.landing_stream(spark, path, schema, 1), store, work_path(spark, "cp"), keep_days=2)
    held = spark.read.parquet(f"{store}/ticks")
    assert sorted(str(r[0]) for r in held.select("market_date").distinct().collect()) == ["2026-01-05", "2026-01-06"] and held.count() == 12
    assert spark.read.parquet(f"{store}/changes").count() == 36


def test_streaks_of_one_dense_source(spark):
    rows = [("a", START + timedelta(milliseconds=i // 2), i % 7 == 0, "e", 60) for i in range(600)]
    df = spark.createDataFrame(rows, LOG).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = [r.consecutive_failures for r in failure_streaks(df).orderBy("ts", "ok").collect()]
    want, n = [], 0
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        n = 0 if r[2] else n + 1
        want.append(n)
    assert sorted(got) == sorted(want)


def test_daily_rows_come_from_the_newest_admitted_snapshot(spark):
    at = lambda h: datetime(2026, 1, 5, h)
    rows = [("a", at(9), 1.0), ("b", at(9), 2.0), ("a", at(15), 3.0)]
    df = spark.createDataFrame([(c, t.date(), t, p, p) for c, t, p in rows], "code string, market_date date, captured_at timestamp, price double, amount double")
    assert sorted((r.code, r.price) for r in stock_daily(df, min_stocks=2).collect()) == [("a", 1.0), ("b", 2.0)]
    assert [(r.code, r.price) for r in stock_daily(df, 400, min_stocks=1).collect()] == [("a", 3.0)]


def test_writes_keep_other_writes(spark):
    base = work_path(spark, "writes")
    rows = lambda k: spark.createDataFrame([(k, f"2026-01-0{k}", f"v{k}", f"s{k}")], "id int, market_date string, dataset_version string, snapshot_id string")
    for k in (1, 2):
        stores.write_index_archive(rows(k), f"{base}/index")
        assert stores.write_archive(rows(k), f"{base}/export", by="market_date") == 1
    assert spark.read.parquet(f"{base}/index").count() == 2 and spark.read.json(f"{base}/export").count() == 2
    stores.write_index_archive(rows(2), f"{base}/index")
    assert spark.read.parquet(f"{base}/index").count() == 2


def test_missing_store_is_new_and_a_broken_one_is_an_error(spark):
    import pytest

    days = spark.createDataFrame([("a", "2026-01-01")], "source string, publish_date_bj string")
    path = work_path(spark, "store")
    assert stores.stored_days(spark, path, days) is None
    spark.createDataFrame([("not", "parquet")], "a string, b string").write.csv(path)
    with pytest.raises(Exception):  # noqa: B017
        stores.stored_days(spark, path, days).count()


def test_shared_folder_must_be_named(monkeypatch):
    import pytest

    from tapeline import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Bare:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Bare())


def test_long_titles(spark):
    from tapeline.operators.asof import name_mentions

    names = spark.createDataFrame([("1", "Abcdef company"), ("2", "xyzw"), ("3", "no")], "code string, name string")
    text = "q" * 60_000 + " abc xyzw " + "Abcdef company" + "r" * 60_000
    got = name_mentions(spark.createDataFrame([(7, text), (8, "xyz"), (9, None)], "doc_id int, title string"), names)
    assert sorted((r.doc_id, r.code) for r in got.collect()) == [(7, "1"), (7, "2")]


def test_many_names_and_a_long_text(spark, monkeypatch):
    """A hundred thousand names against 1 MB of text: one automaton, several, and the join agree with a plain search."""
    from tapeline.operators import asof

    rng = random.Random(2)
    names = [(f"{i:06d}", "".join(rng.choices("bcdfghjkl", k=rng.randint(3, 9)))) for i in range(100_000)]
    names += [("x1", "Twin name"), ("x2", "twin name"), ("x3", "win"), ("x4", "no")]
    long = "".join(rng.choices("bcdfghjkl mnpqr", k=1_000_000))
    texts = [(1, long), (2, "say twinname"), (3, ""), (4, None), (5, "Twin nameTwin name"), (5, "Twin nameTwin name")]
    known, items = spark.createDataFrame(names, "code string, name string"), spark.createDataFrame(texts, "doc_id int, title string")
    flat = items.select("doc_id", asof.normalized_name("title").alias("t")).collect()
    listed = known.select("code", asof.normalized_name("name").alias("n")).collect()
    want = sorted((r.doc_id, k.code) for r in flat for k in listed if r.t and len(k.n) >= 3 and k.n in r.t)
    assert len(want) > 1000 and (5, "x3") in want
    assert sorted(map(tuple, asof.name_mentions(items, known).select("doc_id", "code").collect())) == want
    monkeypatch.setattr(asof, "AUTOMATON_NAMES", 30_000)
    assert sorted(map(tuple, asof.name_mentions(items, known).select("doc_id", "code").collect())) == want
    few = spark.createDataFrame([n for n in names if len(n[1]) >= 8][:500] + names[-4:], "code string, name string")
    some = sorted(map(tuple, asof.name_mentions(items, few).select("doc_id", "code").collect()))
    monkeypatch.setattr(asof, "AUTOMATA", 0)
    assert sorted(map(tuple, asof.name_mentions(items, few).select("doc_id", "code").collect())) == some


def test_names_that_begin_alike_are_dealt_over_automata(spark, monkeypatch):
    """Names with one beginning used to share an automaton, and one left without names cannot be searched."""
    from tapeline.operators import asof

    rows = [(f"{i:06d}", f"Supplier#{i:09d}") for i in range(250)] + [(f"t{i}", "Twin") for i in range(60)]
    known = spark.createDataFrame(rows, "code string, name string")
    items = spark.createDataFrame([(1, "Supplier#000000007: a"), (2, "Supplier#000000249Supplier#000000003"), (3, "twin Twin"), (4, "Supplier#"), (5, None)], "doc_id int, title string")
    want = sorted([(1, "000007"), (2, "000249"), (2, "000003"), *((3, f"t{i}") for i in range(60))])
    sizes, plain = [], asof._mentions_of
    monkeypatch.setattr(asof, "_mentions_of", lambda texts, names: sizes.append(sum(map(len, names.values()))) or plain(texts, names))
    monkeypatch.setattr(asof, "AUTOMATON_NAMES", 100)
    assert sorted(map(tuple, asof.name_mentions(items, known).select("doc_id", "code").collect())) == want
    assert len(sizes) == 4 and sum(sizes) == 310 and max(sizes) < 130
    # no names at all, and more automata than names
    assert asof.name_mentions(items, known.limit(0)).count() == 0
    monkeypatch.setattr(asof, "AUTOMATON_NAMES", 1)
    few = known.where("code IN ('000003', 't1', 't2')")
    assert sorted(map(tuple, asof.name_mentions(items, few).select("doc_id", "code").collect())) == [(2, "000003"), (3, "t1"), (3, "t2")]


def test_outcomes_with_names_in_several_automata(spark, sf_dir, monkeypatch):
    """The driver's supplier names all begin alike, so a replay over more names than one automaton takes used to fail."""
    from tapeline.operators import asof
    from tapeline.queries import all_checks, all_queries
    from tests.compare import connect, differences

    monkeypatch.setattr(asof, "AUTOMATON_NAMES", 3)
    query = "a12_outcome_summary"
    assert differences(all_queries()[query](spark, sf_dir), all_checks()[query], connect(sf_dir)) == []


def test_pages_after_a_row_reach_rows_without_a_time(spark):
    from tapeline.operators.news import page_after

    rows = [(k, None if k % 3 == 0 else f"2026-01-0{k % 4 + 1}") for k in range(20)]
    items, order = spark.createDataFrame(rows, "id int, t string"), [("t", True), ("id", False)]
    want = sorted((k for k, _ in rows), key=lambda k: (rows[k][1] is None, *(-ord(c) for c in rows[k][1] or ""), k))
    seen, last = [want[0]], [rows[want[0]][1], want[0]]
    while got := page_after(items, order, last, 4).collect():
        seen += [r.id for r in got]
        last = [got[-1].t, got[-1].id]
    assert seen == want


def test_announcements_without_any_key_merge_by_address(spark):
    from tapeline.operators.news import merge_duplicates

    rows = [(k, "cninfo", "2026-01-01", "", None, None, f"u{k % 40}") for k in range(400)] + [(500, "cninfo", "2026-01-01", "1", "t", "x", "a"), (501, "cninfo", "2026-01-01", "1", "t", "x", "b")]
    items = spark.createDataFrame(rows, "no bigint, source string, publish_date_bj string, stock_code string, title string, publish_time string, url string")
    got = merge_duplicates(items, "no").collect()
    assert len(got) == 41 and max(len(r.source_urls) for r in got) == 2 and sum(r.n_copies for r in got) == 402


def test_batches_land_in_several_files_and_drain_one_after_the_other(spark):
    import os

    from tapeline.queries.streams import in_batches

    seen, checkpoint = [], work_path(spark, "cp")
    take = lambda landed: S.run_batches(landed, lambda b, _: seen.append(sorted({r.n % 3 for r in b.collect()})), checkpoint)
    in_batches(spark, spark.range(0, 90, 1, 4).withColumnRenamed("id", "n"), F.pmod("n", F.lit(3)), take, 3)
    assert seen == [[0], [1], [2]]
    assert sum(n.isdigit() for n in os.listdir(f"{checkpoint}/offsets")) == 3


def test_only_chunks_with_trades_of_their_own_are_stored_again():
    """Chunks that a late trade moves are read, not written; the watermark asks for none; whole numbers stay whole next to nulls."""
    big = 2**53 + 1

    class Value:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Chunks(dict):
        def getValue(self, key):
            asked.append(key[0])
            return self.get(key)

        def containsKey(self, key):
            return key in self

        def updateValue(self, key, value):
            stored.append(key[0])
            self[key] = value

    class Timers:
        def getCurrentWatermarkInMs(self):
            return 0

    asked, stored, keeper = [], [], T.HeldPosition(4)
    keeper.index, keeper.chunks = Value(), Chunks()
    columns = ["o_0", "s", "q", "has_q", "p", "n", "t", "has_t"]

    def took(*trades):
        asked.clear(), stored.clear()
        frame = pd.DataFrame([(o, s, q or 0, q is not None, p, "N", o, True) for o, s, q, p in trades], columns=columns)
        return next(keeper.handleInputRows((1, "a"), iter([frame]), Timers())).iloc[0]

    first = took(*[(10 * i, "buy", big if i == 0 else 1, 5.0) for i in range(20)])
    assert first.quantity == big + 19 and first.trades == 20 and sorted(stored) == [0, 1, 2, 3, 4]
    late = took((55, "buy", 2, 5.0), (56, "sell", None, None), (57, "buy", big, 7.0))
    assert stored == [1] and set(asked) == {1, 2, 3, 4} and late.replayed == 16
    assert late.quantity == big + 14 and late.rejected == 0 and late.average_cost == 7.0
