"""History backfill: coverage of target sessions and what is still missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def required_stocks(universe: DataFrame, minimum: int, ratio: float = 0.9) -> DataFrame:
    """One row: the number of stocks a complete day must have."""
    n = universe.groupBy().agg(F.count_distinct("code").alias("universe"))
    return n.select("universe", F.greatest(F.lit(minimum), F.floor(F.col("universe") * ratio)).cast("bigint").alias("required"))


def day_coverage(bars: DataFrame, targets: DataFrame, required: Column) -> DataFrame:
    """Stocks per target session against the requirement: complete, incomplete or missing."""
    seen = bars.groupBy("session").agg(F.count_distinct("code").alias("n_stocks"))
    out = targets.select("session").distinct().join(seen, "session", "left").withColumn("n_stocks", F.coalesce("n_stocks", F.lit(0)))
    out = out.withColumn("required", required)
    status = F.when(F.col("n_stocks") == 0, "missing").when(F.col("n_stocks") < F.col("required"), "incomplete").otherwise("complete")
    return out.withColumn("status", status)


def readiness(coverage: DataFrame, minimum_days: int = 15) -> DataFrame:
    n = F.count_if(F.col("status") == "complete")
    return coverage.groupBy().agg(
        n.alias("complete_days"), F.count_if(F.col("status") != "complete").alias("open_days"), (n >= minimum_days).alias("is_ready")
    )


def missing_sessions(targets: DataFrame, complete: DataFrame) -> DataFrame:
    return targets.select("session").distinct().join(complete.select("session"), "session", "left_anti")


def completed_targets(targets: DataFrame, complete: DataFrame) -> DataFrame:
    return targets.select("session").intersect(complete.select("session"))


def covers_range(cached: DataFrame, begin: Column, end: Column) -> DataFrame:
    """Codes whose cached rows span the requested range."""
    span = cached.groupBy("code").agg(F.min("session").alias("cached_begin"), F.max("session").alias("cached_end"))
    return span.withColumn("covers", (F.col("cached_begin") <= begin) & (F.col("cached_end") >= end))


def provider_counts(bars: DataFrame) -> DataFrame:
    return bars.groupBy("provider").agg(F.count_distinct("code").alias("n_codes"))


def day_sources(bars: DataFrame) -> DataFrame:
    """Source label of each historical day: its providers joined by plus signs."""
    names = F.array_sort(F.collect_set(F.nullif(F.col("provider"), F.lit(""))))
    label = F.coalesce(F.nullif(F.array_join(names, "+"), F.lit("")), F.lit("objective_qfq_daily_history"))
    return bars.groupBy("session").agg(label.alias("source_name"), F.count(F.lit(1)).alias("n_rows"))
