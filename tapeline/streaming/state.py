"""Stored state that micro-batches keep: collector health, holdings and intraday changes.

Results do not depend on how rows are dealt to batches, nor on their order: each batch merges its rows into a stored table
and recomputes only what they touch. A batch writes under its own number, so one that is replayed replaces itself.
"""

from __future__ import annotations

import bisect
import json
import pickle
import zlib
from collections.abc import Iterator
from itertools import pairwise
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from tapeline.operators.collectors import open_attempts
from tapeline.operators.intraday import intraday_changes
from tapeline.operators.ledger import apply_trade
from tapeline.sources.stores import delete_matching, delete_path, path_exists
from tapeline.streaming.keyed import run_keyed
from tapeline.streaming.news import run_batches


def latest_version(spark: SparkSession, store: str) -> DataFrame:
    """The table of the highest batch number under ``store``."""
    df = spark.read.option("recursiveFileLookup", False).parquet(store)
    return df.where(F.col("batch") == df.agg(F.max("batch")).first()[0]).drop("batch")


def keep_collector_health(spark: SparkSession, log: DataFrame, store: str, checkpoint: str) -> None:
    """Keeps the attempts that every source's state rests on; ``collector_state`` of ``latest_version`` is the state."""

    def write(batch: DataFrame, number: int) -> None:
        before = f"{store}/batch={number - 1}"
        rows = batch.unionByName(spark.read.schema(batch.schema).parquet(before)) if path_exists(spark, before) else batch
        open_attempts(rows).write.mode("overwrite").parquet(f"{store}/batch={number}")
        delete_path(spark, f"{store}/batch={number - 2}")

    run_batches(log, write, checkpoint)


class HeldPosition(StatefulProcessor):
    """The trades of one key in chunks by order, each with the position before it.

    A trade, late or not, is put into its chunk and replayed from there; where the position before a chunk is what it was, replay
    ends. So a batch reads the chunks it has trades for and those whose start it moves, not the log. Once the watermark has
    passed all trades of the first chunk, it leaves the state, and the position before the next one stands for it.
    """

    def __init__(self, chunk: int):
        self.chunk = chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        # JSON: chunks (number, least order, position before, trades, rejected, newest time), the position after all, trades and rejected of chunks that left
        self.index = handle.getValueState("index", "json string")
        self.chunks = handle.getMapState("chunks", "number bigint", "trades binary")

    def load(self, number: int) -> list[tuple]:
        stored = self.chunks.getValue((number,))
        return unpacked(bytes(stored[0])) if stored else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        chunks, end, left = json.loads(self.index.get()[0]) if self.index.exists() else [[[0, None, None, 0, 0, EARLIEST]], None, [0, 0]]
        for c in chunks:
            c[1] = c[1] and tuple(c[1])
        came = sorted((t for batch in rows for t in trades_of(batch)), key=itemgetter(0))
        # the trades of each chunk begin at its least order; what comes before the first is late
        cuts = [0 if c[1] is None else bisect.bisect_left(came, c[1], key=itemgetter(0)) for c in chunks] + [len(came)]
        late, kept, read, moved, end_so_far, number = cuts[0], [], 0, False, None, max(c[0] for c in chunks)
        for n, (own, least, before, *counts) in enumerate(chunks):
            position, fresh = end_so_far if moved else before, came[cuts[n] : cuts[n + 1]]
            if not fresh and position == before:
                kept.append([own, least, before, *counts])
                moved = False
                continue
            stored = self.load(own)
            read += len(stored)
            trades = in_order(stored, fresh)
            size = self.chunk if len(trades) > 2 * self.chunk else max(len(trades), 1)
            for lo in range(0, len(trades), size):
                part = trades[lo : lo + size]
                if lo:
                    number += 1
                    own, least = number, part[0][0]
                after, rejected = replayed(position, part)
                kept.append([own, least, position, len(part), rejected, newest_time(part)])
                if fresh or lo or size < len(trades):  # else it holds what it did
                    self.chunks.updateValue((own,), (packed(part),))
                position = after
            end_so_far, moved = position, True
        end = end_so_far if moved else end
        while len(kept) > 1 and kept[0][5] is not None and kept[0][5] < 1000 * timerValues.getCurrentWatermarkInMs():
            number, _, _, *counts, _ = kept.pop(0)
            left = [x + y for x, y in zip(left, counts)]
            self.chunks.removeKey((number,))
        self.index.update((json.dumps([kept, end, left]),))
        trades, rejected = (x + sum(c[i] for c in kept) for i, x in enumerate(left, 3))
        row = (key[0], key[1], *((end or GONE)[f] for f in ("name", "quantity", "cost", "opened", "updated")), trades, rejected, late, read)
        kinds = {"quantity": "Int64", "opened_at": "Int64", "last_updated_at": "Int64"}
        yield pd.DataFrame([row], columns=[f.split()[0] for f in HELD.split(", ")]).astype(kinds)

    def close(self) -> None:
        pass


GONE = {"name": None, "quantity": 0, "cost": None, "opened": None, "updated": None}


#: Before all times.
EARLIEST = -(1 << 63)


def trades_of(frame: pd.DataFrame) -> Iterator[tuple]:
    """(order, side, quantity, price, name, time) of each row."""
    columns = {c: frame[c].tolist() for c in frame.columns}
    for value, known in (("q", "has_q"), ("t", "has_t")):  # whole numbers with nulls would come as doubles
        if not all(columns[known]):
            columns[value] = [v if k else None for v, k in zip(columns[value], columns[known])]
    columns["p"] = [None if p is None or p != p else p for p in columns["p"]]
    orders = zip(*(columns[c] for c in frame.columns if c.startswith("o_")))
    return zip(orders, *(columns[c] for c in "sqpnt"))


def packed(trades: list[tuple]) -> bytes:
    """Trades by column and compressed: neighbours in order are much alike, so a chunk takes about a sixth of its rows' size."""
    orders, *fields = zip(*trades)
    return zlib.compress(pickle.dumps([list(zip(*orders)), *fields], 5), 1)


def unpacked(stored: bytes) -> list[tuple]:
    """The trades of ``packed``."""
    orders, *fields = pickle.loads(zlib.decompress(stored))
    return list(zip(zip(*orders), *fields))


def in_order(stored: list[tuple], fresh: list[tuple]) -> list[tuple]:
    """Trades by their order, and equal orders by the other fields."""
    trades = sorted(stored + fresh, key=itemgetter(0))
    if any(x[0] == y[0] for x, y in pairwise(trades)):
        trades.sort(key=lambda t: (t[0], repr(list(t[1:]))))
    return trades


def newest_time(trades: list[tuple]) -> int | None:
    """The newest time of the trades, null where one has none."""
    times = [t[5] for t in trades]
    return None if None in times else max(times, default=EARLIEST)


def replayed(position: dict | None, trades: list) -> tuple[dict | None, int]:
    """The position after more trades, and how many of them were rejected."""
    rejected, position = 0, position and dict(position)
    for _, side, quantity, price, name, at in trades:
        held = position and position["quantity"]
        # by far the most trades add to a known position or sell a part of it, which needs no new one
        if held and quantity and quantity > 0 and side == "sell" and quantity < held:
            position["quantity"], position["updated"] = held - quantity, at
        elif held and quantity and quantity > 0 and side == "buy" and price and price > 0 and (cost := position["cost"]) is not None:
            total = held + quantity
            position.update(name=name, updated=at, quantity=total, cost=round((held * cost + quantity * price) / total, 4))
        else:
            position, accepted = apply_trade(position, side, quantity, price, name, at)
            rejected += not accepted
    return position, rejected


HELD = (
    "account bigint, code string, name string, quantity bigint, average_cost double, opened_at bigint, last_updated_at bigint, trades bigint, rejected bigint, late bigint, replayed bigint"
)


def keep_holdings(trades: DataFrame, order: list[Column], store: str, checkpoint: str, delay: str = "7 days", chunk: int = 256) -> StreamingQuery:
    """The position of every key a batch has trades of, from keyed state; ``present_holdings`` is the newest of each.

    ``trades``: account, code, name, side, quantity, price, at (an instant), in the order of the whole numbers ``order``. Equal orders follow
    by side, quantity and price. ``replayed`` counts the stored trades a batch read for a key. ``delay`` is how late a trade may be: chunks of trades
    that are older than the watermark leave the state, and a trade from before them is counted as ``late`` and not applied. Trades
    without an account or a code are left out.
    """
    named = trades.where(F.col("account").isNotNull() & F.col("code").isNotNull())
    timed = named.withColumn("event_time", F.col("at").cast("timestamp")).withWatermark("event_time", delay)
    whole = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    quantity, time = F.col("quantity").cast("bigint"), F.unix_micros("event_time")
    fields = {f"o_{i}": c.cast("bigint") for i, c in enumerate(order)} | {"s": F.col("side"), "q": whole(quantity), "has_q": quantity.isNotNull()}
    fields |= {"p": F.col("price").cast("double"), "n": F.col("name"), "t": whole(time), "has_t": time.isNotNull()}
    rows = timed.select(F.col("account").cast("bigint").alias("account"), "code", *[c.alias(k) for k, c in fields.items()])
    held = rows.groupBy("account", "code").transformWithStateInPandas(HeldPosition(chunk), HELD, "Append", "EventTime")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/positions/batch={number}")

    return run_keyed(held, write, checkpoint)


def present_holdings(spark: SparkSession, store: str) -> DataFrame:
    """The newest position of every key."""
    rows = spark.read.parquet(f"{store}/positions").withColumns({c: F.timestamp_micros(c) for c in ("opened_at", "last_updated_at")})
    fields = [c for c in rows.columns if c not in ("account", "code", "batch", "replayed", "late")]
    newest = rows.groupBy("account", "code").agg(F.max_by(F.struct(*fields), "batch").alias("p"), F.sum("late").alias("late"))
    return newest.select("account", "code", "p.*", "late")


def keep_intraday(spark: SparkSession, ticks: DataFrame, store: str, checkpoint: str, keep_days: int | None = None) -> None:
    """Appends ticks by day and rewrites the changes of the days a batch touches; days that expire are dropped.

    With ``keep_days``, days that lie that many days or more before the newest one lose their ticks, and their changes
    stay as they are: later ticks of such days are ignored.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("market_date").parquet(f"{store}/ticks/batch={number}")
        log = spark.read.parquet(f"{store}/ticks").where(F.col("batch") <= number)
        days = log.where(F.col("batch") == number).select("market_date").distinct()
        if keep_days is not None and (newest := log.agg(F.max("market_date")).first()[0]):
            first = F.date_sub(F.lit(newest), keep_days - 1)
            days = days.where(F.col("market_date") >= first)
            gone = log.where(F.col("market_date") < first).select(F.col("market_date").cast("string")).distinct().collect()  # a row for each day
        else:
            gone = []
        rows = log.drop("batch").join(days, "market_date", "left_semi")
        changes = intraday_changes(rows)
        changes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("market_date").parquet(f"{store}/changes")
        delete_matching(spark, [f"{store}/ticks/batch=*/market_date={r[0]}" for r in gone])

    run_batches(ticks, write, checkpoint)
