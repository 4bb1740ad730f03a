"""History backfill: which sessions lack a snapshot, and one historical snapshot document for each that has the bars for it.

What is missing follows from the target calendar and the partitions of the store, so a backfill that was interrupted goes on with
what is left. All missing sessions are derived in one keyed pass; each replaces its own day of the store and no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.functions.hashing import historical_snapshot_id
from tapeline.functions.times import date_to_compact
from tapeline.operators.history import day_sources, missing_sessions
from tapeline.plans.snapshot import derive_overview
from tapeline.sources.stores import path_exists

# What a historical document says of itself.
MODE, ADJUSTMENT, SCHEMA_VERSION, CLOSE_CLOCK = "historical", "qfq", "2.0", "15:00:00"


def stored_sessions(spark: SparkSession, store: str) -> DataFrame | None:
    """Sessions that the store has a day for; read from its partitions."""
    if not path_exists(spark, store):
        return None
    days = spark.read.schema("snapshot_id string, session date").parquet(store)  # a store of which no day could be built has no file yet
    return days.select("session").distinct()


def gaps(spark: SparkSession, targets: DataFrame, store: str) -> DataFrame:
    """Target sessions without a document."""
    there = stored_sessions(spark, store)
    return targets.select("session").distinct() if there is None else missing_sessions(targets, there)


def historical_documents(spot: DataFrame, pools: DataFrame, sessions: DataFrame, required: Column, captured_at: Column, requested_days: int) -> DataFrame:
    """One document for each of ``sessions`` that has at least ``required`` stocks: metadata, source status and derived values.

    ``spot``: bars as quotes with snapshot_id, session and provider; ``pools``: pool rows with snapshot_id. Only quotes and pools
    exist for the past, so the derived lists are those of stocks, and the status names the two frames. Identity is made of
    source, date and number of rows: the same bars give the same document.
    """
    rows = spot.join(sessions, "session", "left_semi")
    counts = rows.groupBy("snapshot_id", "session").agg(F.count_distinct("code").alias("n_stocks")).where(F.col("n_stocks") >= required)
    facts = counts.join(day_sources(rows).withColumnRenamed("source_name", "source"), "session")
    chosen = facts.select("snapshot_id")
    derived = derive_overview({"stock": rows.join(chosen, "snapshot_id", "left_semi")}, pools.join(chosen, "snapshot_id", "left_semi"))
    pool_rows = pools.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("pool_rows"))
    out = facts.join(derived, "snapshot_id").join(pool_rows, "snapshot_id", "left")
    date = date_to_compact(F.col("session").cast("string"))
    identity = historical_snapshot_id("source", date, F.col("n_rows").cast("string"))
    status = F.struct(
        F.struct((F.col("n_rows") >= required).alias("ok"), F.col("n_rows").alias("rows")).alias("stock_spot"),
        F.struct((F.coalesce("pool_rows", F.lit(0)) > 0).alias("ok"), F.coalesce("pool_rows", F.lit(0)).alias("rows")).alias("pools"),
    )
    return out.select(
        identity.alias("snapshot_id"), identity.alias("dataset_version"), F.lit(MODE).alias("mode"), "source", F.lit(SCHEMA_VERSION).alias("schema_version"), "session", date.alias("market_date"),
        captured_at.alias("captured_at"), F.concat(F.col("session").cast("string"), F.lit(f"T{CLOSE_CLOCK}+08:00")).alias("source_time"), F.lit(True).alias("window_valid"),
        F.lit(True).alias("is_bootstrap_history"), F.lit(ADJUSTMENT).alias("history_adjustment"), F.lit(requested_days).alias("requested_trading_days"), status.alias("source_status"),
        *[c for c in derived.columns if c != "snapshot_id"],
    )


def write_documents(documents: DataFrame, store: str) -> None:
    """Replaces the days it has documents for, and no other."""
    documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session").parquet(store)


def backfill(spark: SparkSession, spot: DataFrame, pools: DataFrame, targets: DataFrame, store: str, required: Column, captured_at: Column, requested_days: int) -> DataFrame:
    """Fills the gaps and gives the status: requested and complete sessions, those still open, and whether any were written."""
    open_before = gaps(spark, targets, store)
    n_before = open_before.count()
    if n_before:
        write_documents(historical_documents(spot, pools, open_before, required, captured_at, requested_days), store)
    left = gaps(spark, targets, store)
    n_targets = targets.select("session").distinct().count()
    return left.groupBy().agg(
        F.lit(n_targets).alias("target_days"), (F.lit(n_targets) - F.count(F.lit(1))).alias("complete_days"), F.count(F.lit(1)).alias("missing_days"),
        (F.lit(n_before) - F.count(F.lit(1))).alias("written_days"), F.when(F.count(F.lit(1)) == 0, "complete").otherwise("partial").alias("status"),
    )
