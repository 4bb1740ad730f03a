"""Collector run log: failure streaks, backoff, statistics and incremental state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.operators.scaling import ordered_extreme, ordered_totals, range_buckets

MAX_BACKOFF = 3600
STRIKES = 5
STRIKE_PAUSE = 3600
COUNTS = ("fetched", "filtered", "duplicates", "saved", "errors")


def backoff_seconds(failures: Column, base: Column, max_backoff: int = MAX_BACKOFF) -> Column:
    doubled = base * F.pow(F.lit(2), F.least(failures, F.lit(6)))
    return F.least(F.lit(max_backoff), F.greatest(base, doubled)).cast("bigint")


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def failure_streaks(log: DataFrame, together: bool = False) -> DataFrame:
    """Consecutive failures after every attempt, with backoff and pause.

    The streak is the running failure count minus its value at the last success; both are taken inside ranges of about
    equally many attempts first, so one source may hold most of the log. Of attempts at one moment failures come first; if
    they count ``together``, each has the streak after all of them, in which the failures beside a success stay.
    """
    df = _streaks_of_moments(log) if together else _streaks_of_attempts(log)
    failing = ~F.col("ok")
    backoff = F.when(failing, backoff_seconds(F.col("consecutive_failures"), F.col("base_interval")))
    return df.withColumns(
        {
            "backoff": backoff,
            "paused_until": F.when(failing, _plus_seconds(F.col("ts"), backoff)),
            "strike_pause_until": F.when(failing & (F.col("consecutive_failures") >= STRIKES), _plus_seconds(F.col("ts"), F.lit(STRIKE_PAUSE))),
        }
    )


def _streaks_of_attempts(log: DataFrame) -> DataFrame:
    order = ["ts", "ok", "_tie"]
    df = range_buckets(log, ["source"], ["ts", "ok"], "run-log")
    failed = F.when(F.col("ok"), F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    df = ordered_totals(df, ["source"], F.col("_bucket"), order, {"_failed": failed})
    df = ordered_extreme(df, ["source"], F.col("_bucket"), order, F.when(F.col("ok"), F.col("_failed")), "_at_ok")
    return df.withColumn("consecutive_failures", F.col("_failed") - F.coalesce("_at_ok", F.lit(0))).drop("_failed", "_at_ok", "_bucket", "_tie")


def _streaks_of_moments(log: DataFrame) -> DataFrame:
    """One row for each source and moment carries the count, and every attempt at that moment takes it."""
    ok = F.coalesce("ok", F.lit(False))
    moments = log.groupBy(F.col("source").alias("_source"), F.col("ts").alias("_ts")).agg(F.count_if(~ok).alias("_bad"), F.bool_or(ok).alias("_good"))
    df = range_buckets(moments, ["_source"], ["_ts"], "run-log")
    df = ordered_totals(df, ["_source"], F.col("_bucket"), ["_ts"], {"_failed": F.col("_bad")})
    df = ordered_extreme(df, ["_source"], F.col("_bucket"), ["_ts"], F.when(F.col("_good"), F.col("_failed") - F.col("_bad")), "_at_ok")
    df = df.select("_source", "_ts", (F.col("_failed") - F.coalesce("_at_ok", F.lit(0))).alias("consecutive_failures"))
    return log.join(df, log["source"].eqNullSafe(df["_source"]) & log["ts"].eqNullSafe(df["_ts"])).drop("_source", "_ts")


def collector_state(log: DataFrame) -> DataFrame:
    """Current state per source from two combining aggregates; no window over the log."""
    success = log.where("ok").groupBy("source").agg(F.max("ts").alias("last_success_at"))
    joined = log.join(success, "source", "left")
    since = ~F.col("ok") & (F.col("last_success_at").isNull() | (F.col("ts") >= F.col("last_success_at")))
    state = joined.groupBy("source").agg(
        F.max("ts").alias("last_attempt_at"),
        F.max("last_success_at").alias("last_success_at"),
        F.max(F.when(~F.col("ok"), F.col("ts"))).alias("last_failure_at"),
        F.count_if(since).alias("consecutive_failures"),
        F.max_by(F.when(since, F.col("error")), F.when(since, F.col("ts"))).alias("last_error"),
        F.max("base_interval").alias("_base"),
    )
    pause = _plus_seconds(F.col("last_failure_at"), backoff_seconds(F.col("consecutive_failures"), F.col("_base")))
    return state.withColumn("paused_until", F.when(F.col("consecutive_failures") > 0, pause)).drop("_base")


def open_attempts(log: DataFrame) -> DataFrame:
    """The rows that a source's state rests on: those from its last success on, and its last failure.

    ``collector_state`` of these and any later rows is that of the whole log, in whatever order rows come.
    """
    known = log.groupBy("source").agg(
        F.max(F.when(F.col("ok"), F.col("ts"))).alias("_ok_at"), F.max(F.when(~F.col("ok"), F.col("ts"))).alias("_bad_at"), F.max("base_interval").alias("_base")
    )
    needed = F.col("_ok_at").isNull() | (F.col("ts") >= F.col("_ok_at")) | (~F.col("ok") & (F.col("ts") == F.col("_bad_at")))
    rows = log.join(known, "source").where(needed)
    return rows.withColumn("base_interval", F.col("_base")).select(*log.columns)


def run_statistics(log: DataFrame) -> DataFrame:
    """Counts per source and in total (source null), duration, success share and the failed-run rule."""
    runs = log.withColumn("_bad", (F.col("fetched") == 0) & (F.col("saved") == 0) & (F.col("errors") > 0))
    out = runs.rollup("source").agg(
        F.count(F.lit(1)).alias("n_runs"), F.count_if("ok").alias("n_ok"), F.count_if("_bad").alias("failed_runs"),
        *[F.sum(c).alias(c) for c in COUNTS], F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
    )
    span = (F.col("end_time") - F.col("start_time")).cast("interval second").cast("decimal(20,6)").cast("double")
    return out.withColumns({"duration_seconds": span, "success_share": F.round(F.col("n_ok") / F.col("n_runs"), 4)})


def incremental_state(log: DataFrame, archive: DataFrame, now: Column, default_days: int = 15) -> DataFrame:
    """Next collection range per source: from the last success, or ``default_days`` back without one or when the
    archive (source, date) starts later than a day after that."""
    done = log.groupBy("source").agg(
        F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_update"), F.sum(F.when(F.col("ok"), F.col("saved")).otherwise(F.lit(0))).alias("total_collected")
    )
    start = archive.groupBy("source").agg(F.min("date").alias("archive_start"))
    requested = now - F.make_dt_interval(F.lit(default_days))
    short = F.col("archive_start").isNull() | (F.col("archive_start") > F.date_add(requested.cast("date"), 1))
    out = done.join(start, "source", "left")
    return out.withColumns(
        {"range_start": F.when(short | F.col("last_update").isNull(), requested).otherwise(F.col("last_update")), "range_end": now}
    )
