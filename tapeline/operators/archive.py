"""Index archive: merge, incremental sync and the per-day manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions.hashing import content_hash
from tapeline.functions.times import add_minutes, item_collected_at, item_date
from tapeline.operators.scaling import latest_by

DATE_FIELDS = ("publish_time_bj", "publish_time", "crawled_at", "collected_at")
TIME_FIELDS = ("collected_at", "crawled_at", "source_time", "publish_time_bj", "publish_time")


def item_dates(df: DataFrame) -> Column:
    return item_date(*[c for c in DATE_FIELDS if c in df.columns])


def item_times(df: DataFrame) -> Column:
    return item_collected_at(*[c for c in TIME_FIELDS if c in df.columns])


def merge_indexes(payloads: list[DataFrame], date_from: str | Column, date_to: str | Column, tie: str | None = None) -> DataFrame:
    """Union of payloads in order, cut to the dates; per id the last payload wins. Rows without an id get one."""
    tagged = [p.withColumn("_seq", F.lit(i)) for i, p in enumerate(payloads)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    body = sorted(c for c in rows.columns if c not in ("id", "_seq", "_tie"))
    rows = rows.withColumn("item_date", item_dates(rows))
    lo = F.lit(date_from) if isinstance(date_from, str) else date_from
    hi = F.lit(date_to) if isinstance(date_to, str) else date_to
    rows = rows.where((F.col("item_date") != "unknown-date") & F.col("item_date").between(lo, hi))
    made = F.substring(content_hash(rows, body), 1, 24)
    rows = rows.withColumn("id", F.coalesce(F.nullif(F.col("id"), F.lit("")), made))
    order = F.struct("_seq", *([tie] if tie else []))
    return latest_by(rows, ["id"], order).drop("_seq")


def low_watermark(base: DataFrame, overlap_minutes: int = 10) -> DataFrame:
    """Newest collection time less the overlap, and the newest item date, as one row."""
    return base.select(item_times(base).alias("_t"), item_dates(base).alias("_d")).groupBy().agg(
        add_minutes(F.max("_t"), -overlap_minutes).alias("collected_after"),
        F.max(F.when(F.col("_d") != "unknown-date", F.col("_d"))).alias("newest_date"),
    )


def incremental_sync(base: DataFrame, available: DataFrame, end: str, retention_days: int = 15, supports_collected_after: bool = True) -> tuple[DataFrame, DataFrame]:
    """(merged index, one-row report): fetch what was collected after the watermark, or from the day before the
    newest date, and merge it over the retained base."""
    cutoff = F.date_sub(F.lit(end).cast("date"), max(1, retention_days) - 1).cast("string")
    kept = merge_indexes([base], cutoff, end)
    mark = low_watermark(kept)
    dated = available.withColumns({"_d": item_dates(available), "_t": item_times(available)})
    dated = dated.where(F.col("_d").between(cutoff, F.lit(end)))
    if supports_collected_after:
        delta = dated.where(F.col("_t") > mark.select("collected_after").scalar())
    else:
        from_day = F.date_sub(mark.select(F.col("newest_date").cast("date")).scalar(), 1).cast("string")
        delta = dated.where(F.col("_d") >= from_day)
    delta = delta.drop("_d", "_t")
    merged = merge_indexes([kept.drop("item_date"), delta], cutoff, end)
    report = mark.select(
        F.lit("collected_after" if supports_collected_after else "date_overlap").alias("strategy"), cutoff.alias("date_from"),
        F.lit(end).alias("date_to"), "collected_after",
        delta.groupBy().count().scalar().alias("downloaded_count"), merged.groupBy().count().scalar().alias("merged_count"),
    )
    return merged, report


def archive_manifest(items: DataFrame, snapshots: DataFrame, current_version: DataFrame | None = None) -> DataFrame:
    """One row per archived day: newest snapshot, item counts and version drift."""
    day = items.withColumn("market_date", item_dates(items)).where(F.col("market_date") != "unknown-date")
    counts = day.groupBy("market_date").agg(
        F.count_if(F.col("source") != "cninfo").alias("news_count"), F.count_if(F.col("source") == "cninfo").alias("announcement_count")
    )
    snaps = snapshots.groupBy("market_date").agg(
        F.count(F.lit(1)).alias("snapshot_count"), F.max_by("snapshot_id", F.struct("captured_at", "snapshot_id")).alias("snapshot_id")
    )
    out = counts.join(snaps, "market_date", "full_outer").fillna(0, ["news_count", "announcement_count", "snapshot_count"])
    out = out.withColumn("is_complete", (F.col("snapshot_count") > 0) & (F.col("news_count") + F.col("announcement_count") > 0))
    if current_version is not None:
        stored = current_version.select("market_date", F.col("dataset_version").alias("_v"), "published_version")
        out = out.join(stored, "market_date", "left").withColumn("version_drift", F.coalesce(F.col("_v") != F.col("published_version"), F.lit(False))).drop("_v", "published_version")
    return out


def session_context(manifest: DataFrame, market_days: int = 15) -> DataFrame:
    """Last market days of the manifest with the history range they span."""
    recent = manifest.where("snapshot_count > 0").orderBy(F.desc("market_date")).limit(market_days)
    span = recent.groupBy().agg(F.min("market_date").alias("history_from"), F.max("market_date").alias("history_to"))
    return recent.withColumns({"history_from": span.select("history_from").scalar(), "history_to": span.select("history_to").scalar()})
