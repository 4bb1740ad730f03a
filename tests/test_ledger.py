"""Holdings: golden cases, random logs and the split at full exits."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tapeline.operators import ledger as G
from tapeline.queries import all_queries

SCHEMA = "account bigint, code string, name string, seq bigint, side string, quantity bigint, price double, at timestamp"


def frame(spark, trades):
    start = datetime(2026, 1, 1)
    rows = [(a, c, "N", i, s, q, p, start + timedelta(hours=i)) for i, (a, c, s, q, p) in enumerate(trades)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("at", F.col("at").cast("timestamp_ntz")).repartition(3)


def result(df):
    return {(r.account, r.code): (r.quantity, r.average_cost, r.rejected) for r in df.collect()}


def test_weighted_cost_partial_and_full_sell(spark):
    log = [(1, "a", "buy", 100, 10.0), (1, "a", "buy", 100, 12.0)]
    assert result(G.holdings(frame(spark, log)))[(1, "a")] == (200, 11.0, 0)
    log.append((1, "a", "sell", 50, None))
    assert result(G.holdings(frame(spark, log)))[(1, "a")] == (150, 11.0, 0)
    log.append((1, "a", "sell", None, None))
    held = G.holdings(frame(spark, log))
    assert result(held)[(1, "a")] == (0, None, 0) and G.open_positions(held).count() == 0


def test_unknown_quantity_rejects_adds_and_partial_sells(spark):
    log = [(1, "a", "upsert", None, None), (1, "a", "buy", 10, 5.0), (1, "a", "sell", 5, None), (1, "b", "sell", 5, None), (1, "c", "buy", -1, 3.0)]
    got = result(G.holdings(frame(spark, log)))
    assert got[(1, "a")] == (None, None, 2)
    assert got[(1, "b")] == (0, None, 1) and got[(1, "c")] == (0, None, 1)


def plain(log):
    """The ledger applied trade by trade."""
    start, want = datetime(2026, 1, 1), {}
    for i, (a, c, s, q, p) in enumerate(log):
        pos, trades, rej = want.get((a, c), (None, 0, 0))
        pos, ok = G.apply_trade(pos, s, q, p, f"N{i % 3}", start + timedelta(hours=i))
        want[(a, c)] = (pos, trades + 1, rej + (not ok))
    empty = {"name": None, "quantity": 0, "cost": None, "opened": None, "updated": None}
    return {k: (*(tuple((p or empty)[f] for f in ("name", "quantity", "cost", "opened", "updated"))), t, r) for k, (p, t, r) in want.items()}


def whole(spark, log, partitions=3):
    start = datetime(2026, 1, 1)
    rows = [(a, c, f"N{i % 3}", i, s, q, p, start + timedelta(hours=i)) for i, (a, c, s, q, p) in enumerate(log)]
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp", "timestamp_ntz")).repartition(partitions)
    return {(r.account, r.code): (r.name, r.quantity, r.average_cost, r.opened_at, r.last_updated_at, r.trades, r.rejected) for r in G.holdings(df).collect()}


def log_of(rng, n, sides, codes="wxyz", unknown=0.0):
    log = []
    for _ in range(n):
        code = "hot" if rng.random() < 0.4 else rng.choice(codes)
        side = rng.choice(sides)
        q = None if rng.random() < unknown else rng.randint(-1, 9)
        p = None if rng.random() < unknown else round(rng.uniform(-1, 50), 2)
        log.append((1, code, side, q, p))
    return log


def test_buys_and_sells_with_a_hot_key(spark):
    log = log_of(random.Random(11), 1500, ["buy", "sell", "sell"])
    assert whole(spark, log) == plain(log)


def test_corrections_of_both_numbers(spark):
    log = log_of(random.Random(12), 1500, ["buy", "buy", "sell", "upsert"])
    assert whole(spark, log) == plain(log)


def test_unknown_numbers_everywhere(spark):
    for seed in range(4):
        log = log_of(random.Random(seed), 700, ["buy", "buy", "sell", "upsert", "upsert"], "abcdefgh", 0.3)
        assert whole(spark, log) == plain(log)


def test_short_logs_of_all_kinds(spark):
    rng, log = random.Random(13), []
    for key in range(600):
        for _ in range(rng.randint(1, 6)):
            log.append((key, "k", rng.choice(["buy", "sell", "upsert"]), rng.choice([None, None, -1, 3, 5]), rng.choice([None, 2.0, 4.0, -1.0])))
    assert whole(spark, log) == plain(log)


def test_a_hot_key_is_cut_into_ranges(spark):
    log = log_of(random.Random(14), 3000, ["buy", "sell", "upsert"])
    rows = G.moved(frame(spark, log))
    assert rows.where("code = 'hot'").count() > 1000
    held, want = {}, []
    for i, (a, c, s, q, p) in enumerate(log):
        want.append((i, held.get(c, (None, True))[0]["quantity"] if held.get(c, (None, True))[0] else 0))
        held[c] = G.apply_trade(held.get(c, (None, True))[0], s, q, p, "N", None)
    assert sorted((r.seq, r.held) for r in rows.collect()) == want


def test_only_runs_with_an_unknown_number_are_applied(spark):
    """A key with one such run among many has its other runs told by their quantities, but the last."""
    log = [(1, "a", "upsert", None, None), (1, "a", "buy", 1, 1.0), (1, "a", "sell", None, None)]
    for i in range(50):
        log += [(1, "a", "buy", 3, 2.0), (1, "a", "sell", 9 if i % 3 else 1, None), (1, "a", "sell", None, None)]
    log += [(1, "a", "buy", 4, 2.5), (1, "a", "buy", 4, 3.5)]
    assert whole(spark, log) == plain(log)
    applied, fold = spark.sparkContext.accumulator(0), G._fold

    def counted(batches):
        def passed():
            for b in batches:
                applied.add(b.num_rows)
                yield b

        yield from fold(passed())

    G._fold = counted
    try:
        assert whole(spark, log) == plain(log)
    finally:
        G._fold = fold
    assert 0 < applied.value <= 5


def test_no_trades(spark):
    assert G.holdings(frame(spark, [(1, "a", "buy", 1, 1.0)]).limit(0)).count() == 0


def test_streamed_positions_equal_the_batch_fold(spark, sf_dir):
    q = all_queries()
    batch = {(r.account, r.code): (r.quantity, r.average_cost, r.rejected) for r in q["c17_holdings"](spark, sf_dir).collect()}
    live = {(r.account, r.code): (r.quantity, r.average_cost, r.rejected) for r in q["r07_holdings_state"](spark, sf_dir).collect()}
    assert batch == live
