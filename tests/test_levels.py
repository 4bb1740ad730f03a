"""Upserts in levels: merging in any grouping, bounded rewriting, and recovery between any two steps."""

import random

import pytest
from pyspark.sql import functions as F

from tapeline.operators.news import merge_duplicates
from tapeline.session import work_path
from tapeline.streaming import levels as U

SCHEMA = "no bigint, source string, publish_date_bj string, stock_code string, title string, publish_time string, url string, collected_at string"
FIELDS = ("source", "publish_date_bj", "item_key", "no", "title", "url", "collected_at", "source_urls", "n_copies")


def news(seed, n, days=5):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        source, story = rng.choice(["cls", "cninfo"]), rng.randint(0, 12)
        blank = source == "cninfo" and story == 0
        out.append((k, source, f"2026-01-0{1 + story % days}", "" if blank else f"{story}", None if blank else f"story {story}", None if blank else "t", rng.choice([None, "", f"u{rng.randint(0, 5)}"]), f"c{rng.randint(0, 99):02d}"))
    rng.shuffle(out)
    return out


def rows(df):
    return sorted(repr(tuple(r[f] for f in FIELDS)) for r in df.collect())


def test_merging_in_any_grouping_is_merging_at_once(spark):
    all_rows = news(1, 120)
    want = rows(merge_duplicates(spark.createDataFrame(all_rows, SCHEMA), "no"))
    part = lambda r: U.partial(spark.createDataFrame(r, SCHEMA), "no")
    assert rows(U.finished(U.merged(part(all_rows)))) == want
    a, b, c = (U.merged(part(all_rows[k::3])) for k in range(3))
    assert rows(U.finished(U.merged(U.merged(a.unionByName(c)).unionByName(b)))) == want


def test_batches_merge_in_levels_and_publish_only_days_due(spark):
    store, target, batches = work_path(spark, "levels"), work_path(spark, "days"), [news(k, 12) for k in range(7)]
    batches = [[(100 * k + r[0], *r[1:]) for r in b] for k, b in enumerate(batches)]
    written = []

    class Counted(U.Store):
        def write(self, parts, name, level, first, last):
            made = super().write(parts, name, level, first, last)
            written.append((level, first, last))
            return made

    for number, batch in enumerate(batches):
        U.add_batch(Counted(spark, store), spark.createDataFrame(batch, SCHEMA), number, "no", fanout=2)
    assert written == [(0, 0, 0), (0, 1, 1), (1, 0, 1), (0, 2, 2), (0, 3, 3), (1, 2, 3), (2, 0, 3), (0, 4, 4), (0, 5, 5), (1, 4, 5), (0, 6, 6)]
    held = U.Store(spark, store)
    assert [(f["first"], f["last"]) for f in held.state["fragments"]] == [(0, 3), (4, 5), (6, 6)]
    assert len(U.publish(held, target)) == 5 and U.publish(held, target) == [] and U.publish(U.Store(spark, store), target) == []
    want = merge_duplicates(spark.createDataFrame(sum(batches, []), SCHEMA), "no")
    read = lambda: spark.read.parquet(target).withColumn("publish_date_bj", F.col("publish_date_bj").cast("string"))
    assert rows(read()) == rows(want) == rows(U.upserted(spark, store))
    more = [(900, "cls", "2026-01-02", "1", "new story", "t", "n1", "c00")]
    U.add_batch(held, spark.createDataFrame(more, SCHEMA), 7, "no", fanout=2)
    assert U.publish(held, target) == ["2026-01-02"]
    assert rows(read()) == rows(merge_duplicates(spark.createDataFrame(sum(batches, more), SCHEMA), "no"))


def test_a_batch_that_is_replayed_is_taken_in_once(spark):
    store, batch = work_path(spark, "levels"), spark.createDataFrame(news(3, 20), SCHEMA)
    for number in (0, 0, 1, 0, 1):
        U.add_batch(U.Store(spark, store), batch, number, "no", fanout=2)
    assert sum(r.n_copies for r in U.upserted(spark, store).collect()) == 40


@pytest.mark.parametrize("step", ["write", "commit", "sweep", "publish"])
def test_death_between_any_two_steps_loses_and_doubles_nothing(spark, monkeypatch, step):
    store, target, batches = work_path(spark, "levels"), work_path(spark, "days"), [[(100 * k + r[0], *r[1:]) for r in news(k, 10)] for k in range(3)]
    dies = {"left": 0}

    def fragile(fn, before):
        def run(*args, **more):
            dies["left"] -= 1
            if dies["left"] == 0 and before:
                raise RuntimeError("killed")
            out = fn(*args, **more)
            if dies["left"] == 0:
                raise RuntimeError("killed")
            return out

        return run

    def go():
        for number, batch in enumerate(batches):
            held = U.Store(spark, store)
            U.add_batch(held, spark.createDataFrame(batch, SCHEMA), number, "no", fanout=2)
            U.publish(held, target)

    owner, name = (U, "write_news_store") if step == "publish" else (U.Store, step)
    plain = getattr(owner, name)
    for left, before in ((1, True), (2, False), (3, True)):
        dies["left"] = left
        monkeypatch.setattr(owner, name, fragile(plain, before))
        try:
            go()
        except RuntimeError as e:
            assert "killed" in str(e)
    monkeypatch.setattr(owner, name, plain)
    go()
    want = rows(merge_duplicates(spark.createDataFrame(sum(batches, []), SCHEMA), "no"))
    assert rows(U.upserted(spark, store)) == want
    assert rows(spark.read.parquet(target).withColumn("publish_date_bj", F.col("publish_date_bj").cast("string"))) == want
