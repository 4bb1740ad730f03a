"""Snapshot derivation: summary, ranked lists and industry counts of every snapshot in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.operators import market


def derive_snapshot(frames: dict[str, DataFrame], pools: DataFrame, allow_chinext: bool = False) -> dict[str, DataFrame]:
    """The derived tables: ``summary``, ``rankings``, ``pool_industry_counts`` and the ``pools`` themselves."""
    return {
        "summary": market.market_summary(frames["stock"], pools, allow_chinext=allow_chinext),
        "rankings": market.ranked_lists(frames, allow_chinext=allow_chinext),
        "pool_industry_counts": market.pool_industry_counts(pools),
        "pools": pools,
    }


def derive_overview(frames: dict[str, DataFrame], pools: DataFrame) -> DataFrame:
    """One row per snapshot over the derived tables."""
    parts = derive_snapshot(frames, pools)
    ranked = parts["rankings"].groupBy("snapshot_id").agg(
        F.count(F.lit(1)).alias("n_ranked"),
        F.max(F.when((F.col("list") == "top_gainers") & (F.col("rank") == 1), F.col("code"))).alias("top_gainer"),
    )
    hottest = parts["pool_industry_counts"].where("rank = 1").select("snapshot_id", F.col("industry").alias("hottest_industry"))
    out = parts["summary"].join(ranked, "snapshot_id", "left").join(hottest, "snapshot_id", "left")
    return out.select(
        "snapshot_id", "stock_count", "tradeable_stock_count", "limit_up_count", "market_breadth", "broken_limit_ratio",
        F.coalesce("n_ranked", F.lit(0)).alias("n_ranked"), F.coalesce("top_gainer", F.lit("")).alias("top_gainer"),
        F.coalesce("hottest_industry", F.lit("")).alias("hottest_industry"),
    )
