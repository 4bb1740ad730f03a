"""Keyed state of streams in Spark's own state store.

``first_copies`` keeps, for each key, the order of the first copy seen so far and the time until which the key is remembered. Spark
holds it in RocksDB, partitioned by key, checkpoints its changes with each batch and restores them after a crash. The
watermark decides both ends: rows that come after it has passed their event time are routed aside, and an event-time
timer drops a key once the watermark has passed its newest row by ``hold``. So the state is two numbers for each key
with a row in the last ``delay`` plus ``hold`` of event time, however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROUTED = "item_key string, arrival bigint, route string, payload string"
ROUTED_ROW = Row(*[f.split()[0] for f in ROUTED.split(", ")])


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; a running query keeps the setting it was started with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


class FirstCopy(StatefulProcessor):
    """Emits a row that comes before all of its key so far in arrival order, and every row that is late.

    Most keys have a row or two in a batch, so rows come as they are: a data frame for each key would cost more than its work.
    """

    def __init__(self, hold_ms: int):
        self.hold_ms = hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "arrival bigint, until_ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held, until = self.first.get() or (None, None)
        best, newest = None, until
        for r in rows:
            if r.event_ms is not None and r.event_ms < watermark:
                yield ROUTED_ROW(r.item_key, r.arrival, "late", r.payload)
                continue
            if best is None or (r.arrival, r.payload) < (best.arrival, best.payload):
                best = r
            if r.event_ms is not None:
                newest = max(newest or 0, r.event_ms + self.hold_ms)
        if best is not None:
            if held is None or best.arrival < held:
                yield ROUTED_ROW(best.item_key, best.arrival, "first", best.payload)
                held = best.arrival
            if newest is not None and newest != until:
                self.handle.registerTimer(newest)
            self.first.update((held, newest))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if ((self.first.get() or (None, None))[1] or 0) <= expiredTimerInfo.getExpiryTimeInMs():
            self.first.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_copies(items: DataFrame, key: Column, arrival: Column, hold: str = "1 day") -> DataFrame:
    """From a stream with a watermarked ``event_time``: (item_key, arrival, route, payload), route ``first`` or ``late``.

    ``arrival`` is a whole number without ties inside a key. A ``first`` row replaces those of its key with later arrival, so
    the row with the least arrival is the first copy however rows are dealt to batches. Rows whose event time the watermark
    has passed are ``late`` and change no state; rows without an event time are never late, and a key that has only such
    rows is kept for good. ``payload`` is the whole row as JSON; ``unpacked`` reads it.
    """
    payload = F.to_json(F.struct(*[F.col(c) for c in items.columns if c != "event_time"]), {"ignoreNullFields": "false"})
    # the time as a plain number: Spark itself would drop late rows of a watermarked column unseen
    rows = items.select(key.alias("item_key"), arrival.cast("bigint").alias("arrival"), F.unix_millis("event_time").alias("event_ms"), payload.alias("payload"))
    hold_ms = items.sparkSession.sql(f"SELECT unix_millis(TIMESTAMP_MILLIS(0) + INTERVAL {hold})").first()[0]
    return rows.groupBy("item_key").transformWithState(FirstCopy(hold_ms), ROUTED, "Append", "EventTime")


def unpacked(routed: DataFrame, schema: str) -> DataFrame:
    """The rows themselves, with item_key and arrival before them."""
    return routed.select("item_key", "arrival", F.from_json("payload", schema).alias("_row")).select("item_key", "arrival", "_row.*")


def run_keyed(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Drain what is available through ``write(batch, number)``; keyed state and its changes lie under ``checkpoint``."""
    with rocksdb_state(df.sparkSession):
        query = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def keep_distinct(items: DataFrame, key: Column, arrival: Column, store: str, checkpoint: str, hold: str = "1 day") -> StreamingQuery:
    """First copies and late rows of every batch, under the batch's own number: one that is replayed replaces itself.

    A batch reads nothing that was stored before it. ``distinct_items`` and ``late_rows`` read the store.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/batch={number}")

    return run_keyed(first_copies(items, key, arrival, hold), write, checkpoint)


def distinct_items(spark: SparkSession, store: str, schema: str) -> DataFrame:
    """One whole row for each key: the first copy in arrival order."""
    rows = spark.read.schema(ROUTED).parquet(store).where(F.col("route") == "first")
    first = rows.groupBy("item_key").agg(F.min_by("payload", "arrival").alias("payload"), F.min("arrival").alias("arrival"))
    return unpacked(first, schema)


def late_rows(spark: SparkSession, store: str, schema: str) -> DataFrame:
    """The rows that came after the watermark had passed them."""
    return unpacked(spark.read.schema(ROUTED).parquet(store).where(F.col("route") == "late"), schema)
