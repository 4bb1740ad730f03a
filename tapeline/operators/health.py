"""Source health, freshness, manifests and the health report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions import constants
from tapeline.functions.hashing import dataset_version
from tapeline.functions.times import iso_to_beijing, seconds_between


def source_health(items: DataFrame, date: str = "publish_date_bj") -> DataFrame:
    """Per source: stored days, items, newest publish time, coverage and newest write."""
    out = items.groupBy("source").agg(
        F.count_distinct(date).alias("files"), F.count(F.lit(1)).alias("items"), F.max("publish_time_bj").alias("newest_publish_time"),
        F.min(date).alias("coverage_start_date"), F.max(date).alias("coverage_end_date"), F.max("collected_at").alias("newest_collected_at"),
    )
    days = F.datediff(F.col("coverage_end_date").cast("date"), F.col("coverage_start_date").cast("date")) + 1
    return out.withColumn("covered_calendar_days", days)


def staleness(health: DataFrame, now: Column, reference: str, thresholds: Mapping[str, int] = constants.SOURCE_STALE_MINUTES) -> DataFrame:
    """Age in minutes against the source's limit."""
    limit = F.lit(constants.DEFAULT_STALE_MINUTES)
    for s, v in thresholds.items():
        limit = F.when(F.col("source") == s, F.lit(v)).otherwise(limit)
    age = F.round(seconds_between(now, F.col(reference)) / 60, 2)
    return health.withColumns({"age_minutes": age, "stale_after_minutes": limit}).withColumns(
        {
            "missing": F.coalesce("files", F.lit(0)) == 0,
            "is_stale": F.col("age_minutes").isNull() | (F.col("age_minutes") > F.col("stale_after_minutes")),
        }
    )


def with_collectors(health: DataFrame, state: DataFrame) -> DataFrame:
    """Stored data and collector state side by side; a source may be known to either only."""
    return health.join(state.select("source", "last_success_at", "consecutive_failures", "last_error", "paused_until"), "source", "full_outer")


def health_report(items: DataFrame, state: DataFrame, now: Column, frames: DataFrame | None = None, key: str = "snapshot_id") -> DataFrame:
    """Freshness of every source: last success counts first, the newest stored item otherwise.

    ``frames`` (snapshot_id, frame, ok, error) is the frame status of snapshots; the report then also has the names of the
    frames that the newest one lacks.
    """
    both = with_collectors(source_health(items), state)
    ref = F.coalesce("last_success_at", iso_to_beijing("newest_collected_at"))
    report = staleness(both.withColumn("_ref", ref), now, "_ref").drop("_ref").fillna(0, ["files", "items", "consecutive_failures"])
    if frames is None:
        return report
    lacking = missing_frames(frames, frames.agg(F.max(key)).scalar(), key)
    return report.withColumn("missing_frames", lacking.agg(F.array_sort(F.collect_set("frame"))).scalar())  # a snapshot has a few frames


def missing_frames(status: DataFrame, newest_snapshot: Column, key: str = "snapshot_id") -> DataFrame:
    return status.where((F.col(key) == newest_snapshot) & ~F.col("ok")).select(key, "frame", "error")


def sources_summary(items: DataFrame, now: Column) -> DataFrame:
    """Counts, newest time, latency of the newest item and items of the last day."""
    at = iso_to_beijing("publish_time_bj")
    return items.withColumn("_at", at).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_items"), F.max("publish_time_bj").alias("newest_time"),
        F.max_by("latency_minutes", F.struct("_at", "id")).alias("latest_latency_minutes"),
        F.count_if(F.col("_at") > now - F.make_dt_interval(F.lit(1))).alias("items_24h"),
    )


def manifest(items: DataFrame, page_sizes: Mapping[str, int] = {"news": 200, "announcements": 100}) -> DataFrame:
    """One row per dataset: version, newest item, counts and where the second page starts.

    The two datasets are flagged on one scan; announcements also belong to news.
    """
    sets = F.filter(F.array(F.lit("news"), F.when(F.col("source") == "cninfo", F.lit("announcements"))), lambda x: x.isNotNull())
    rows = items.withColumn("dataset", F.explode(sets))
    facts = rows.groupBy("dataset").agg(
        F.count_distinct("source", "publish_date_bj").alias("files"), F.max("publish_time_bj").alias("source_time"),
        F.max_by("crawled_at", F.struct("publish_time_bj", "id")).alias("collected_at"), F.count(F.lit(1)).alias("expected_count"),
        F.sum(F.length("content").cast("bigint")).alias("size_chars"),
    )
    version = dataset_version(rows, "id", ["dataset"]).drop("n_members")
    size = F.lit(0)
    for name, n in page_sizes.items():
        size = F.when(F.col("dataset") == name, F.lit(n)).otherwise(size)
    out = facts.join(version, "dataset").withColumn("_size", size)
    return out.withColumns(
        {"actual_count": F.col("expected_count"), "is_complete": F.lit(True), "next_offset": F.when(F.col("expected_count") > F.col("_size"), F.col("_size"))}
    ).drop("_size")
