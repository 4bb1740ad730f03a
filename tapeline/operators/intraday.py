"""Stock history routes: daily rows, intraday observations and their changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.operators.scaling import latest_by, neighbours, range_buckets


def intraday_changes(ticks: DataFrame) -> DataFrame:
    """Change of price and amount since the previous and since the first observation of the day.

    ``ticks`` holds (code, market_date, captured_at, price, amount); observations are cut into ranges of about equally
    many, so one busy code does not become one task. Those of one moment go by amount, then price.
    """
    by = ["code", "market_date"]
    cut = range_buckets(ticks, by, ["captured_at", "amount", "price"], "ticks")
    df = neighbours(cut, by, F.col("_bucket"), F.struct("captured_at", "amount", "price", "_tie"), ["price", "amount"])
    gap = lambda c, base, places: F.round(F.col(c) - F.col(f"{base}_{c}"), places)
    return df.select(
        *ticks.columns,
        gap("price", "prev", 4).alias("price_change_from_previous"),
        gap("amount", "prev", 2).alias("amount_change_from_previous"),
        gap("price", "first", 4).alias("price_change_from_first"),
        gap("amount", "first", 2).alias("amount_change_from_first"),
    )


def stock_intraday(ticks: DataFrame, code: str, market_date: str) -> DataFrame:
    return intraday_changes(ticks.where((F.col("code") == code) & (F.col("market_date") == market_date)))


MIN_STOCKS = 1000


def day_snapshots(ticks: DataFrame, min_stocks: int = MIN_STOCKS) -> DataFrame:
    """(market_date, captured_at) of each day's newest admitted snapshot: not failed, and with enough stocks.

    A snapshot is the set of ticks captured at one moment; ``failed`` is optional in ``ticks``.
    """
    failed = F.bool_or(F.coalesce("failed", F.lit(False))) if "failed" in ticks.columns else F.lit(False)
    found = ticks.groupBy("market_date", "captured_at").agg(F.count_distinct("code").alias("n"), failed.alias("bad"))
    return found.where((F.col("n") >= min_stocks) & ~F.col("bad")).groupBy("market_date").agg(F.max("captured_at").alias("captured_at"))


def stock_daily(ticks: DataFrame, days: int = 30, date_from: str = "", date_to: str = "", code: str | None = None, min_stocks: int = MIN_STOCKS) -> DataFrame:
    """Rows of the newest admitted snapshot of each of the newest ``days`` days that have one, then the date range.

    Codes that are absent from a day's snapshot have no row for it.
    """
    recent = day_snapshots(ticks, min_stocks).orderBy(F.desc("market_date")).limit(max(1, days))
    rows = ticks if code is None else ticks.where(F.col("code") == code)
    if date_from:
        rows = rows.where(F.col("market_date") >= date_from)
    if date_to:
        rows = rows.where(F.col("market_date") <= date_to)
    return latest_by(rows.join(recent, ["market_date", "captured_at"], "left_semi"), ["code", "market_date"], F.struct("captured_at", "amount", "price"))
