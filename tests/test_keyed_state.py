"""Keyed stream state: first copies, late rows, restart and expiry."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tapeline.session import work_path
from tapeline.streaming import keyed as K
from tapeline.streaming import news as S

SCHEMA = "no bigint, k string, note string, collected_at string"
START = datetime(2026, 1, 1)


def batches(spark, groups):
    """One file, and so one batch, for each group of rows."""
    path = work_path(spark, "landing")
    for rows in groups:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(path)
    return S.landing_stream(spark, path, SCHEMA, 1)


def row(no, key, minutes):
    return (no, key, f"note {no}", (START + timedelta(minutes=minutes)).strftime("%Y-%m-%d %H:%M:%S"))


def keep(spark, groups, delay, hold, store, checkpoint, items=None):
    items = batches(spark, groups) if items is None else items
    return K.keep_distinct(S.with_event_time(items, delay=delay), F.col("k"), F.col("no"), store, checkpoint, hold)


def test_whole_first_rows_in_shuffled_batches_with_a_hot_key(spark):
    rng = random.Random(7)
    rows = [row(i, "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 30)}", rng.randint(0, 5000)) for i in range(400)]
    rows.append((400, "no time", "note 400", None))
    want = {}
    for r in rows:
        want[r[1]] = min(want.get(r[1], r), r)
    rng.shuffle(rows)
    store = work_path(spark, "first")
    keep(spark, [rows[k::4] for k in range(4)], "1000 days", "1 day", store, work_path(spark, "cp"))
    got = K.distinct_items(spark, store, SCHEMA).select("no", "k", "note", "collected_at").collect()
    assert {tuple(r) for r in got} == set(want.values()) and len(got) == len(want)
    assert K.late_rows(spark, store, SCHEMA).count() == 0


def test_late_rows_are_routed_and_change_nothing(spark):
    groups = [[row(5, "a", 60), row(6, "b", 100)], [row(1, "a", 89), row(2, "a", 91), row(3, "c", 20)], [row(0, "b", 95)]]
    store = work_path(spark, "late")
    keep(spark, groups, "10 minutes", "1 day", store, work_path(spark, "cp"))
    assert {(r.k, r.no) for r in K.distinct_items(spark, store, SCHEMA).collect()} == {("a", 2), ("b", 0)}
    assert {(r.k, r.no) for r in K.late_rows(spark, store, SCHEMA).collect()} == {("a", 1), ("c", 3)}


def test_restart_after_a_crash_in_batch_zero_and_later(spark):
    groups = [[row(10 * b + i, f"k{(b + i) % 7}", 10 * i) for i in range(9)] for b in range(3)]
    items, store, checkpoint, died = batches(spark, groups), work_path(spark, "crash"), work_path(spark, "cp"), []

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{store}/batch={number}")
        if number not in died and number in (0, 2):
            died.append(number)
            raise RuntimeError("executor lost")

    for _ in range(2):
        with pytest.raises(Exception, match="executor lost"):
            K.run_keyed(K.first_copies(S.with_event_time(items, delay="1000 days"), F.col("k"), F.col("no")), write, checkpoint)
    K.run_keyed(K.first_copies(S.with_event_time(items, delay="1000 days"), F.col("k"), F.col("no")), write, checkpoint)
    want = {}
    for r in sum(groups, []):
        want[r[1]] = min(want.get(r[1], r), r)
    got = K.distinct_items(spark, store, SCHEMA).select("no", "k", "note", "collected_at").collect()
    assert died == [0, 2] and {tuple(r) for r in got} == set(want.values())


def test_state_is_dropped_when_the_watermark_has_passed(spark):
    groups = [[row(100 * b + i, f"k{b}-{i}", 600 * b + i) for i in range(20)] for b in range(5)]
    groups.append([row(900, "k0-0", 3300)])  # long forgotten: counts as new, but is no earlier copy
    store = work_path(spark, "expiry")
    query = keep(spark, groups, "10 minutes", "30 minutes", store, work_path(spark, "cp"))
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(rows) <= 4 * 20 * 2 and rows[-1] <= 6
    got = K.distinct_items(spark, store, SCHEMA)
    assert got.count() == 100 and got.where("k = 'k0-0'").first().no == 0


def test_rows_of_a_key_are_taken_as_they_are():
    class Value:
        value = None

        def get(self):
            return self.value

        def exists(self):
            return self.value is not None

        def update(self, value):
            self.value = value

    class Timers:
        def getCurrentWatermarkInMs(self):
            return 100

        registerTimer = list().append

    keeper, Item = K.FirstCopy(50), Row("item_key", "arrival", "event_ms", "payload")
    keeper.first, keeper.handle = Value(), Timers()
    took = lambda *items: [tuple(r) for r in keeper.handleInputRows(("a",), iter(Item("a", *i) for i in items), Timers())]
    assert took((5, 200, "x"), (3, None, "y"), (1, 99, "z")) == [("a", 1, "late", "z"), ("a", 3, "first", "y")]
    assert keeper.first.value == (3, 250)
    assert took((4, 300, "u")) == [] and keeper.first.value == (3, 350)
    assert took((2, 150, "v")) == [("a", 2, "first", "v")] and keeper.first.value == (2, 350)
