"""Factor channels: a registry of (condition, score) column pairs over the replay features.

Users add their own ``Channel``; nothing here needs Python at run time, so Spark compiles all of it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions.numbers import all_of, finite, holds, in_range, truthy
from tapeline.operators.scaling import top_n

C = F.col
R5, LIQ, CALM = "ret5_pct_rank", "liquidity_proxy_pct_rank", "atr5_pct_rank"


@dataclass(frozen=True)
class Channel:
    """``condition`` and ``score`` build columns over a feature row; null counts as not met."""

    id: str
    name: str
    condition: Callable[[], Column]
    score: Callable[[], Column]


def common_gate(max_pct: tuple[float, float] = (5.5, 7.5)) -> Column:
    """Shared precondition; ``max_pct`` holds the overnight and the morning limit."""
    ceiling = F.when(C("mode") == "overnight", F.lit(max_pct[0])).otherwise(F.lit(max_pct[1]))
    return all_of(
        truthy("ma5"), truthy("ma10"), C("ret5").isNotNull(), C("volume_ratio5").isNotNull(),
        F.coalesce(C(LIQ), F.lit(0.0)) >= 0.18, F.coalesce(C("risk_hits"), F.lit(0)) == 0,
        C("pct") < ceiling, F.coalesce(C("big_gain_days3"), F.lit(0)) <= 1,
    )


def _between(**ranges: tuple[float, float]) -> list[Column]:
    return [in_range(name, low, high) for name, (low, high) in ranges.items()]


def _null_or(name: str, test: Column) -> Column:
    return C(name).isNull() | test


def _breakout() -> Column:
    return C("close") / F.nullif(C("prior_high10"), F.lit(0.0))


# Thresholds and weights of the ten standard channels.
STANDARD_CHANNELS = (
    Channel(
        "T01", "低位多周期趋势",
        lambda: all_of(
            C("close") > C("ma5"), C("ma5") > C("ma10") * 0.995, _null_or("ret10", in_range("ret10", -1.0, 16.0)),
            C("close_position") >= 0.55, C("upper_shadow") <= 0.045,
            *_between(ret5=(1.0, 9.0), range_position10=(0.42, 0.86), volume_ratio5=(0.72, 1.8), pct=(-0.8, 4.5)),
        ),
        lambda: 30 * C("ret5") / 9 + 18 * C("close_position") + 18 * C(R5) + 12 * C(LIQ) - 100 * C("upper_shadow"),
    ),
    Channel(
        "T02", "缩量回踩承接",
        lambda: all_of(
            C("close") >= C("ma10") * 0.99, _null_or("ret10", C("ret10") >= 1.5), C("close_position") >= 0.48,
            C("lower_shadow") >= C("upper_shadow") * 0.7,
            *_between(drawdown_high10=(-9.0, -0.8), pct=(-2.8, 1.3), volume_ratio5=(0.35, 0.98)),
        ),
        lambda: 30 * (1 - C("volume_ratio5")) + 20 * C("close_position") + 15 * (C("drawdown_high10") + 9) / 8.2 + 15 * C(LIQ),
    ),
    Channel(
        "T03", "温和放量突破",
        lambda: all_of(
            in_range(_breakout(), 0.975, 1.035), C("upper_shadow") <= 0.035, C("close_position") >= 0.68,
            *_between(pct=(0.4, 5.0), volume_ratio5=(1.08, 2.4), ret5=(1.0, 11.0)),
        ),
        lambda: 35 * F.least(_breakout(), F.lit(1.02)) + 20 * C("close_position") + 15 * F.least(C("volume_ratio5"), F.lit(1.8))
        + 15 * C(R5) - 100 * C("upper_shadow"),
    ),
    Channel(
        "T04", "强势回撤修复",
        lambda: all_of(
            C("pullback_days3") >= 1, C("close") >= C("ma5") * 0.985,
            *_between(ret10=(4.0, 20.0), pct=(-1.2, 2.8), range_position10=(0.52, 0.9), volume_ratio5=(0.5, 1.55), drawdown_high10=(-8.0, -0.5)),
        ),
        lambda: 25 * C(R5) + 20 * C("close_position") + 20 * (C("pullback_days3") / 3) + 15 * C(LIQ) + C("ret10"),
    ),
    Channel(
        "T05", "波动收缩点火",
        lambda: all_of(
            C("close") >= C("ma10") * 0.99,
            *_between(compression=(0.25, 0.82), range_position10=(0.3, 0.76), drawdown_high10=(-16.0, -2.0), pct=(-1.3, 2.6),
                      volume_ratio5=(0.5, 1.45), atr5=(0.5, 7.0)),
        ),
        lambda: 35 * (1 - C("compression")) + 20 * C("close_position") + 15 * (1 - C("range_position10")) + 15 * C(LIQ),
    ),
    Channel(
        "T06", "相对强度容量",
        lambda: all_of(
            C(R5) >= 0.76, C(LIQ) >= 0.62, C(CALM) >= 0.45, in_range("pct", -1.0, 4.8), _null_or("ret10", C("ret10") <= 20.0),
            C("range_position10") <= 0.92, C("close_position") >= 0.52,
        ),
        lambda: 35 * C(R5) + 30 * C(LIQ) + 20 * C(CALM) + 15 * C("close_position"),
    ),
    Channel(
        "T07", "公司硬催化趋势",
        lambda: all_of(
            C("positive_hits") >= 1, C("close") >= C("ma5") * 0.98,
            *_between(ret5=(-3.0, 11.0), pct=(-2.2, 4.8), volume_ratio5=(0.45, 2.1)),
        ),
        lambda: 38 * F.least(C("positive_hits"), F.lit(3)) + 12 * C("ann_count") + 20 * C("close_position") + 15 * C(LIQ),
    ),
    Channel(
        "T08", "消息潜伏低位",
        lambda: all_of(
            C("news_mentions") >= 1, C("range_position10") <= 0.7, C("close") >= C("ma10") * 0.975,
            _null_or("ret10", in_range("ret10", -5.0, 13.0)), *_between(pct=(-2.2, 3.2), volume_ratio5=(0.45, 1.6)),
        ),
        lambda: 35 * F.least(C("news_mentions"), F.lit(4)) + 18 * (1 - C("range_position10")) + 15 * C("close_position") + 15 * C(LIQ),
    ),
    Channel(
        "T09", "底部反转修复",
        lambda: all_of(
            holds(C("cross_ma3")) | holds(C("close") > C("ma3")), C("close_position") >= 0.62, C("lower_shadow") >= 0.002,
            *_between(ret10=(-16.0, 2.5), range_position10=(0.08, 0.58), pct=(0.15, 4.2), volume_ratio5=(0.72, 2.2)),
        ),
        lambda: 30 * C("close_position") + 20 * (1 - C("range_position10")) + 18 * F.least(C("volume_ratio5"), F.lit(1.6)) + 15 * C(LIQ),
    ),
    Channel(
        "T10", "风险调整共振",
        lambda: all_of(
            C("close") >= C("ma10") * 0.98,
            *_between(ret5=(-1.5, 9.0), pct=(-1.3, 4.2), range_position10=(0.22, 0.82), volume_ratio5=(0.58, 1.75), atr5=(0.4, 8.0)),
        ),
        lambda: 20 * C(R5) + 18 * C(LIQ) + 18 * C(CALM) + 16 * C("close_position") + 12 * (1 - F.abs(C("volume_ratio5") - 1.05))
        + (F.least(C("positive_hits"), F.lit(2)) * 8 + F.least(C("news_mentions"), F.lit(2)) * 4)
        - (F.greatest(C("ret5") - 6, F.lit(0)) * 2 + F.greatest(C("range_position10") - 0.72, F.lit(0)) * 30),
    ),
)

PICK_COLUMNS = (
    "code", "name", "close", "pct", "ret5", "ret10", "volume_ratio5", "range_position10", "drawdown_high10", "close_position",
    "atr5", LIQ, "positive_hits", "risk_hits", "news_mentions", "ann_count",
)


def channel_scores(features: DataFrame, channels: Sequence[Channel] = STANDARD_CHANNELS, gate: Column | None = None) -> DataFrame:
    """One row per feature row and channel whose gate and condition hold."""
    passed = features.where(gate if gate is not None else common_gate())
    cells = [F.struct(F.lit(ch.id).alias("channel"), F.when(holds(ch.condition()), finite(ch.score().cast("double"))).alias("score")) for ch in channels]
    scored = passed.withColumn("_c", F.explode(F.filter(F.array(*cells), lambda x: x["score"].isNotNull())))
    return scored.select(*features.columns, "_c.channel", "_c.score")


def channel_picks(scores: DataFrame, n: int = 3) -> DataFrame:
    """Best ``n`` codes per decision and channel: score, then liquidity, then code."""
    best = top_n(scores, ["mode", "decision_no", "channel"], [F.desc("score"), F.desc("liquidity_proxy"), F.asc("code")], n)
    return best.select("mode", "decision_no", "channel", "rank", F.round("score", 4).alias("score"), *PICK_COLUMNS)


def eligible_counts(scores: DataFrame) -> DataFrame:
    return scores.groupBy("mode", "decision_no", "channel").agg(F.count(F.lit(1)).alias("eligible"))


def days_with_pick(picks: DataFrame) -> DataFrame:
    return picks.where("rank = 1").groupBy("mode", "channel").agg(F.count(F.lit(1)).alias("days_with_pick"))


def consensus(picks: DataFrame, n: int = 5) -> DataFrame:
    """Votes across channels (4 - rank each), best first; a code has at most one entry per channel."""
    votes = picks.groupBy("mode", "decision_no", "code").agg(
        F.max("name").alias("name"),
        F.sum(4 - F.col("rank")).alias("votes"),
        F.array_sort(F.collect_list("channel")).alias("channels"),
    )
    return top_n(votes, ["mode", "decision_no"], [F.desc("votes"), F.desc(F.size("channels")), F.desc("code")], n)
