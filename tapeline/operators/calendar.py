"""Trading calendar: a date dimension per market, its neighbours and the snapshot slots of a day.

A calendar holds one row per date, so its windows are bounded by the length of the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions import constants

SEARCH_DAYS = 400


def calendar_dim(
    trade_dates: DataFrame, first: Column, last: Column, closed: DataFrame | None = None, opened: DataFrame | None = None,
    covered_years: Sequence[int] = (), weekday_fallback: bool = False, market: str = "CN",
) -> DataFrame:
    """Dates with ``is_trade_day``, the neighbours and a running ``session_no``.

    A date trades when it is opened by override, or else when it is neither closed nor a weekend and is a cached trade
    date, lies in a covered year, or weekdays are accepted as they are. Inputs hold one ``date`` column.
    """
    spark = trade_dates.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))

    def member(df: DataFrame | None, name: str, base: DataFrame) -> DataFrame:
        if df is None:
            return base.withColumn(name, F.lit(False))
        flags = df.select("date").distinct().withColumn(name, F.lit(True))
        return base.join(flags, "date", "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))

    days = member(opened, "_open", member(closed, "_closed", member(trade_dates, "_cached", days)))
    weekend = F.dayofweek("date").isin(1, 7)
    known = F.col("_cached") | F.year("date").isin(*covered_years) if covered_years else F.col("_cached")
    if weekday_fallback:
        known = F.lit(True)
    dim = days.select(F.lit(market).alias("market"), "date", (F.col("_open") | (~F.col("_closed") & ~weekend & known)).alias("is_trade_day"))
    return with_neighbours(dim)


def with_neighbours(dim: DataFrame) -> DataFrame:
    w = Window.partitionBy("market").orderBy("date")
    trade = F.when(F.col("is_trade_day"), F.col("date"))
    near = lambda c, a, b: F.when(F.datediff(a, b) <= SEARCH_DAYS, c)
    dim = dim.withColumns(
        {
            "_p": F.last(trade, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
            "_n": F.first(trade, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)),
            "session_no": F.sum(F.col("is_trade_day").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    return dim.select(
        "market", "date", "is_trade_day", "session_no",
        near(F.col("_p"), F.col("date"), F.col("_p")).alias("previous_trade_day"),
        near(F.col("_n"), F.col("_n"), F.col("date")).alias("next_trade_day"),
    )


def attach_trade_days(df: DataFrame, dim: DataFrame, date: str = "date", include_current: bool = False) -> DataFrame:
    """Previous and next trade day of any date column."""
    side = dim.select(F.col("date").alias(date), "is_trade_day", "previous_trade_day", "next_trade_day")
    out = df.join(side, date, "left").withColumn("is_trade_day", F.coalesce("is_trade_day", F.lit(False)))
    if include_current:
        for c in ("previous_trade_day", "next_trade_day"):
            out = out.withColumn(c, F.when(F.col("is_trade_day"), F.col(date)).otherwise(F.col(c)))
    return out


def completed_trade_days(dim: DataFrame, now: str, n: int, close_at: str = "15:10:00") -> DataFrame:
    """Last ``n`` completed trade days at a wall-clock time; today counts from ``close_at``."""
    day, clock = now[:10], now[11:19]
    today = F.lit(day).cast("date")
    done = (F.col("date") <= today) if clock >= close_at else (F.col("date") < today)
    return dim.where(F.col("is_trade_day") & done).orderBy(F.desc("date")).limit(n).select("date")


def expected_slots(dim: DataFrame, slots: Sequence[tuple[str, str]] = constants.SNAPSHOT_SLOTS) -> DataFrame:
    """Every daily slot of every trade day: (date, slot, mode, at)."""
    cells = F.array(*[F.struct(F.lit(s).alias("slot"), F.lit(m).alias("mode")) for s, m in slots])
    rows = dim.where("is_trade_day").select("date", F.explode(cells).alias("s")).select("date", "s.slot", "s.mode")
    return rows.withColumn("at", F.concat_ws(" ", F.col("date").cast("string"), F.concat("slot", F.lit(":00"))).cast("timestamp_ntz"))


def missing_slots(dim: DataFrame, snapshots: DataFrame, slots: Sequence[tuple[str, str]] = constants.SNAPSHOT_SLOTS) -> DataFrame:
    """Expected snapshots that were not taken; ``snapshots`` holds captured_at."""
    text = F.col("captured_at").cast("string")
    taken = snapshots.select(F.substring(text, 1, 10).cast("date").alias("date"), F.substring(text, 12, 5).alias("slot"))
    return expected_slots(dim, slots).join(taken.distinct(), ["date", "slot"], "left_anti")


def next_slot(dim: DataFrame, times: DataFrame, at: str = "now", slots: Sequence[tuple[str, str]] = constants.SNAPSHOT_SLOTS) -> DataFrame:
    """First slot after each time: later today, or the first one of the next trade day."""
    ordered = sorted(slots)
    arr = F.array(*[F.struct(F.lit(s).alias("slot"), F.lit(m).alias("mode")) for s, m in ordered])
    t = F.col(at).cast("string")
    day = times.withColumn("date", F.substring(t, 1, 10).cast("date"))
    side = dim.select("date", "is_trade_day", "next_trade_day")
    later = F.get(F.filter(arr, lambda x: F.concat(x["slot"], F.lit(":00")) > F.substring(t, 12, 15)), F.lit(0))
    pick = F.when(F.col("is_trade_day"), later)
    out = day.join(side, "date", "left").withColumn("_s", F.coalesce(pick, F.get(arr, F.lit(0))))
    run_day = F.when(pick.isNotNull(), F.col("date")).otherwise(F.col("next_trade_day"))
    return out.select(*times.columns, run_day.alias("run_date"), F.col("_s.slot").alias("slot"), F.col("_s.mode").alias("mode"))


def calendar_summary(dim: DataFrame, trade_dates: DataFrame, today: str, source: str = "cache", covered_years: Sequence[int] = (), n_closed: int = 0, n_open: int = 0) -> DataFrame:
    """One row about the calendar as of a day."""
    fact = lambda e: trade_dates.groupBy().agg(e).scalar()
    day = dim.where(F.col("date") == F.lit(today).cast("date"))
    day = day.select(F.col("date").alias("current_date"), "is_trade_day", "previous_trade_day", "next_trade_day")
    day = day.withColumns(
        {
            "trade_date_count": fact(F.count_distinct("date")), "first_trade_date": fact(F.min("date")), "last_trade_date": fact(F.max("date")),
        }
    )
    fallback = "override_file" if covered_years else "unavailable"
    return day.withColumns(
        {
            "available": (F.col("trade_date_count") > 0) | F.lit(bool(covered_years)),
            "source": F.when(F.col("trade_date_count") > 0, F.lit(source)).otherwise(F.lit(fallback)),
            "closed_date_count": F.lit(n_closed), "open_date_count": F.lit(n_open),
        }
    )


def session_neighbours(sessions: DataFrame) -> DataFrame:
    """Previous and next session of a market's own session list (market, session)."""
    w = Window.partitionBy("market").orderBy("session")
    return sessions.select("market", "session", F.lag("session").over(w).alias("previous"), F.lead("session").over(w).alias("next"))
