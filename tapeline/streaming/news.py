"""News streams: ingest, dedup, late rows, keyword windows, upsert and the join with decisions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeline.functions.hashing import dedup_hash
from tapeline.functions.times import iso_to_beijing, latency_level
from tapeline.operators.keywords import extract_keywords, item_text
from tapeline.streaming import keyed

OVERLAP = "10 minutes"


def landing_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None, form: str = "json") -> DataFrame:
    """New files of a landing folder, JSON unless ``form`` names another format, as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(form).load(path)


def event_time(column: str) -> Column:
    """A Beijing time text as an instant."""
    return F.convert_timezone(F.lit("Asia/Shanghai"), F.current_timezone(), iso_to_beijing(column)).cast("timestamp")


def with_event_time(items: DataFrame, column: str = "collected_at", delay: str = OVERLAP) -> DataFrame:
    """Collection time as event time (an instant), with the overlap the incremental sync uses."""
    return items.withColumn("event_time", event_time(column)).withWatermark("event_time", delay)


def keep_distinct(items: DataFrame, store: str, checkpoint: str, arrival: str, delay: str = OVERLAP, hold: str = "1 day") -> StreamingQuery:
    """The first copy of every item in order of ``arrival``, and the rows later than ``delay``; see ``streaming.keyed``."""
    return keyed.keep_distinct(with_event_time(items, delay=delay), dedup_hash(), F.col(arrival), store, checkpoint, hold)


def keyword_counts(
    items: DataFrame, plates: Mapping[str, Sequence[str]], window: str = "1 hour", slide: str | None = None, top_n: int = 20, start: str | None = None
) -> DataFrame:
    """Keyword counts per tumbling (or sliding) window of event time.

    Windows are aligned to UTC; ``start`` moves them (``"16 hours"`` makes day windows Beijing days).
    """
    words = items.select("event_time", F.explode(extract_keywords(item_text(items), top_n, plates=plates)).alias("keyword"))
    win = F.window("event_time", window, slide, start)
    counts = words.groupBy(win.alias("w"), "keyword").agg(F.count(F.lit(1)).alias("n_items"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "keyword", "n_items")


def keep_keyword_counts(spark: SparkSession, items: DataFrame, store: str, checkpoint: str, plates: Mapping[str, Sequence[str]], **windows) -> None:
    """Counts of each batch, and how far its event time reaches; late rows count like any other."""

    def write(batch: DataFrame, number: int) -> None:
        timed = batch.withColumn("event_time", event_time("collected_at"))
        keyword_counts(timed, plates, **windows).write.mode("overwrite").parquet(f"{store}/counts/batch={number}")
        timed.agg(F.max("event_time").alias("reached")).write.mode("overwrite").parquet(f"{store}/reached/batch={number}")

    run_batches(items, write, checkpoint)


def keyword_windows(spark: SparkSession, store: str, threshold: int = 5, delay: str = OVERLAP) -> DataFrame:
    """Counts above the threshold of the windows that event time has passed by ``delay``; later rows still correct them."""
    reached = spark.read.parquet(f"{store}/reached").agg(F.max("reached")).first()[0]
    counts = spark.read.parquet(f"{store}/counts").where(F.col("window_end") <= F.lit(reached) - F.expr(f"INTERVAL {delay}"))
    total = counts.groupBy("window_start", "keyword").agg(F.sum("n_items").alias("n_items"))
    return total.where(F.col("n_items") > threshold)


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Drain what is available into a Parquet table."""
    q = df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint)
    q.trigger(availableNow=True).start().awaitTermination()


def run_batches(df: DataFrame, fn, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Drain what is available through ``fn(batch, batch_id)``."""
    q = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def split_late(items: DataFrame, path: str, checkpoint: str, limit_minutes: float = 180.0) -> None:
    """On-time rows and over-late rows to two tables, keyed by batch so that a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        leveled = batch.withColumn("latency_level", latency_level("latency_minutes"))
        late = F.coalesce(F.col("latency_minutes") > limit_minutes, F.lit(True))
        leveled.where(~late).write.mode("overwrite").parquet(f"{path}/on_time/batch={batch_id}")
        leveled.where(late).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")

    run_batches(items, write, checkpoint)


def visible_to_decisions(messages: DataFrame, decisions: DataFrame, stamp: str = "stamp") -> DataFrame:
    """Stream-static interval join: equality on the covered day, then the exact bounds."""
    days = F.explode(F.sequence(F.col("lower").cast("date"), F.col("cutoff").cast("date")))
    wanted = decisions.select("mode", "decision_no", "lower", "cutoff", days.alias("_day"))
    dated = messages.withColumn("_day", F.col(stamp).cast("date"))
    return dated.join(wanted, "_day").where((F.col(stamp) >= F.col("lower")) & (F.col(stamp) <= F.col("cutoff"))).drop("_day", "lower", "cutoff")
