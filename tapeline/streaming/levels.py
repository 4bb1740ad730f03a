"""Upserts of micro-batches into a store by day, in levels that merge by size under a manifest.

A batch is written as a fragment of its own. When ``FANOUT`` fragments of a level are there, they are merged to one of the next, so an
item is rewritten once a level and the number of fragments grows with the logarithm of the batches. The manifest lists the live
fragments, the batches they hold and their days. It is a small file that is written whole under the next number; the highest
number that is whole is the state, and switching it is the last step of every change. What a killed step has written is in no manifest: it is
overwritten or ignored, never read.

Merging keeps what a later merge needs (the first arrival's row, each address with its first arrival, the number of
copies), so it does not matter in which order or how often fragments are merged.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tapeline.operators.news import collection_time, item_key, item_urls
from tapeline.sources.stores import NEWS_KEYS, delete_path, month_of, path_exists, write_news_store
from tapeline.streaming.news import run_batches

FANOUT = 4
GROUP = [*NEWS_KEYS, "item_key"]
DAY = NEWS_KEYS[-1]


# --- mergeable rows --------------------------------------------------------------------------------------------


def partial(items: DataFrame, arrival: str) -> DataFrame:
    """Items as rows that merge: the whole row, its arrival, and each address with the arrival and place it had."""
    rest = F.struct(*[c for c in items.columns if c not in (*NEWS_KEYS, "source_urls", "collected_at", "crawled_at")])
    a = F.col(arrival).cast("bigint")
    urls = F.transform(item_urls(items), lambda u, i: F.struct(a.alias("arrival"), i.alias("place"), u.alias("url")))
    return items.select(*NEWS_KEYS, item_key(items).alias("item_key"), rest.alias("first"), a.alias("arrival"), collection_time(items).alias("collected_at"), F.lit(1).cast("bigint").alias("n_copies"), urls.alias("urls"))


def merged(parts: DataFrame) -> DataFrame:
    """One row per key; merging merged rows again, in any grouping, gives the same."""
    one = parts.groupBy(*GROUP).agg(F.min_by("first", "arrival").alias("first"), F.min("arrival").alias("arrival"), F.min("collected_at").alias("collected_at"), F.sum("n_copies").alias("n_copies"))
    each = parts.select(*GROUP, F.explode("urls").alias("u")).groupBy(*GROUP, "u.url").agg(F.min(F.struct("u.arrival", "u.place")).alias("at"))
    urls = each.groupBy(*GROUP).agg(F.sort_array(F.collect_list(F.struct("at.arrival", "at.place", "url"))).alias("urls"))
    kept = [one[c] for c in one.columns]
    same = one["item_key"].eqNullSafe(urls["item_key"])
    for k in NEWS_KEYS:
        same = same & one[k].eqNullSafe(urls[k])
    return one.join(urls, same, "left").select(*kept, F.coalesce(urls["urls"], F.expr("array()").cast(parts.schema["urls"].dataType)).alias("urls"))


def finished(parts: DataFrame) -> DataFrame:
    """Stored items from merged rows: the columns of ``merge_duplicates``."""
    fields = parts.schema["first"].dataType.names
    return parts.select(
        *GROUP, *[F.col("first")[c].alias(c) for c in fields], "collected_at", F.col("collected_at").alias("crawled_at"),
        F.transform("urls", lambda u: u["url"]).alias("source_urls"), "n_copies",
    )


# --- manifest --------------------------------------------------------------------------------------------------


class Store:
    """Fragments under a manifest. ``state``: fragments (path, level, first and last batch, days, rows), and days due to be published."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.number, self.state = self._newest()

    def _newest(self) -> tuple[int, dict]:
        folder = f"{self.path}/manifest"
        found = [f.getPath().getName() for f in self.fs.listStatus(self.fs_path(folder))] if path_exists(self.spark, folder) else []
        numbers = sorted(int(n[:-5]) for n in found if n.endswith(".json"))
        if not numbers:
            return 0, {"fragments": [], "due": []}
        stream = self.fs.open(self.fs_path(f"{folder}/{numbers[-1]:010d}.json"))
        try:
            return numbers[-1], json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, state: dict) -> None:
        """Makes ``state`` the present one: its file is written under another name and renamed when it is whole."""
        folder, number = f"{self.path}/manifest", self.number + 1
        draft, final = self.fs_path(f"{folder}/{number:010d}.draft"), self.fs_path(f"{folder}/{number:010d}.json")
        out = self.fs.create(draft, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not self.fs.rename(draft, final):
            raise RuntimeError(f"manifest {number} is there already: two writers share {self.path}")
        self.number, self.state = number, state
        delete_path(self.spark, f"{folder}/{number - 2:010d}.json")

    def read(self, fragments: list[dict]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{f['path']}" for f in fragments])

    def write(self, parts: DataFrame, name: str, level: int, first: int, last: int) -> dict:
        """A fragment in the order of its days, so that a reader of some days skips the files of others."""
        where = f"{self.path}/{name}"
        parts.repartitionByRange(DAY, "item_key").sortWithinPartitions(DAY).write.mode("overwrite").parquet(where)
        days = self.spark.read.schema(parts.schema).parquet(where).groupBy(F.col(DAY).cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each day
        return {"path": name, "level": level, "first": first, "last": last, "days": sorted(r.day for r in days if r.day is not None), "rows": sum(r.n for r in days)}

    def sweep(self) -> None:
        """Deletes fragments that no manifest lists: merged ones, and what a killed step left."""
        live = {f["path"] for f in self.state["fragments"]}
        folder = f"{self.path}/fragments"
        if path_exists(self.spark, folder):
            for f in self.fs.listStatus(self.fs_path(folder)):
                if f"fragments/{f.getPath().getName()}" not in live:
                    self.fs.delete(f.getPath(), True)


def add_batch(store: Store, items: DataFrame, number: int, arrival: str, fanout: int = FANOUT) -> None:
    """Takes a batch in, once however often it is replayed, and merges what has become due. Reads no fragment of another level."""
    fragments = store.state["fragments"]
    if not any(f["first"] <= number <= f["last"] for f in fragments):
        fresh = store.write(merged(partial(items, arrival)), f"fragments/{number}-{number}-0", 0, number, number)
        store.commit({"fragments": [*fragments, fresh], "due": sorted({*store.state["due"], *fresh["days"]})})
    while due := _due(store.state["fragments"], fanout):
        first, last, level = due[0]["first"], due[-1]["last"], due[0]["level"] + 1
        made = store.write(merged(store.read(due)), f"fragments/{first}-{last}-{level}", level, first, last)
        store.commit({**store.state, "fragments": [made if f is due[0] else f for f in store.state["fragments"] if f not in due[1:]]})
        store.sweep()


def _due(fragments: list[dict], fanout: int) -> list[dict]:
    """The oldest fragments of the lowest level that has ``fanout`` of them."""
    for level in sorted({f["level"] for f in fragments}):
        of = [f for f in fragments if f["level"] == level]
        if len(of) >= fanout:
            return of[:fanout]
    return []


def publish(store: Store, target: str) -> list[str]:
    """Rewrites the months of ``target`` that batches since the last time have rows of, and lists the days of those rows. Without such batches it reads nothing.

    A month is written whole from the live fragments, so a publication that was killed is simply made again.
    """
    days = store.state["due"]
    if days:
        months = {d[:7] for d in days}
        holding = [f for f in store.state["fragments"] if any(d[:7] in months for d in f["days"])]
        rows = store.read(holding).where(month_of(DAY).isin(sorted(months)))
        write_news_store(finished(merged(rows)), target)
        store.commit({**store.state, "due": []})
    return days


def keep_upserts(items: DataFrame, store: str, target: str, checkpoint: str, arrival: str, fanout: int = FANOUT, publish_every: int = 1) -> StreamingQuery:
    """Every micro-batch as a fragment; the days it touches are published every so many batches."""

    def write(batch: DataFrame, number: int) -> None:
        held = Store(batch.sparkSession, store)
        add_batch(held, batch, number, arrival, fanout)
        if (number + 1) % publish_every == 0:
            publish(held, target)

    return run_batches(items, write, checkpoint)


def upserted(spark: SparkSession, store: str) -> DataFrame:
    """All items of the live fragments, merged."""
    held = Store(spark, store)
    return finished(merged(held.read(held.state["fragments"])))
