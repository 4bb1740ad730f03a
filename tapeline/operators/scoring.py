"""Overnight candidate score: a rule table over stock, fund flow, pools, industry heat and market breadth.

Each rule adds to three scores and may leave a reason, a risk note, a high-open note or a next-day fund source.
All rules of a row become sums of conditional constants, evaluated in one projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions.numbers import holds, or_else

YI = 100_000_000


@dataclass
class Rule:
    cond: Column
    score: Column | float = 0.0
    accept: Column | float = 0.0
    high: Column | float = 0.0
    reason: Column | None = None
    risk: Column | None = None
    note: Column | None = None
    source: Column | None = None


def _say(pattern: str, *cols: Column) -> Column:
    return F.format_string(pattern, *cols) if cols else F.lit(pattern)


def with_industry_heat(stocks: DataFrame, heat: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """Heat row of each candidate's industry as struct ``heat``; null when there is none."""
    side = heat.select(key, "industry", F.struct("score", "limit_up_count", "strong_count", "previous_limit_count").alias("heat"))
    return stocks.join(side, [key, "industry"], "left")


def candidate_industry() -> Column:
    """Industry from the previous-limit, strong or broken pool record, in that order."""
    parts = [F.nullif(F.col(f"{p}.industry"), F.lit("")) for p in ("previous_limit", "strong", "broken")]
    return F.coalesce(*parts, F.lit(""))


def resolved_inputs(df: DataFrame) -> DataFrame:
    """Fill zero quote fields from the pool records and derive the close position."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    chain = lambda c, pools: reduce(lambda a, p: or_else(a, zero(f"{p}.{c}")), pools, zero(c))
    return df.withColumns(
        {
            "turnover": chain("turnover", ("strong", "previous_limit", "broken")),
            "volume_ratio": chain("volume_ratio", ("strong",)),
            "speed": chain("speed", ("strong", "previous_limit", "broken")),
            "amplitude": chain("amplitude", ("previous_limit", "broken")),
            "close_position": F.when(F.col("high") > F.col("low"), (F.col("price") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0),
        }
    )


def _rules() -> tuple[list[Rule], Column]:
    c, lit = F.col, F.lit
    cap = lambda e, top: F.least(e, lit(float(top)))
    pct, amount, turnover, vr = c("pct"), c("amount"), c("turnover"), c("volume_ratio")
    speed, chg5, cp, amp = c("speed"), c("change_5m"), c("close_position"), c("amplitude")
    net, net_pct = F.coalesce(c("flow.main_net"), lit(0.0)), F.coalesce(c("flow.main_net_pct"), lit(0.0))
    breadth, broken_ratio = F.coalesce(c("market_breadth"), lit(0.0)), F.coalesce(c("broken_limit_ratio"), lit(0.0))
    heat = c("heat")
    hot = (heat["limit_up_count"] >= 5) & (heat["strong_count"] >= 8) & (heat["previous_limit_count"] >= 4)
    warmth = cap(F.coalesce(heat["score"], lit(0.0)), 18)
    core, top, low = pct.between(1.0, 7.5), (pct > 7.5) & (pct <= 9.3), (pct >= -1.5) & (pct < 1.0)
    vol, up, up5 = cap(vr, 6) * 3.0, cap(speed, 3) * 4.0, cap(chg5, 4) * 3.0
    inflow = cap(net / YI, 8) * 3.0
    rotation = F.when(heat.isNull(), "medium").when(hot, "high").when(heat["limit_up_count"] >= 3, "medium").otherwise("low")
    rules = [
        # Bands, weights and messages of the score.
        Rule(core, pct * 4.0, cap(pct * 4.0, 24), 0.0, _say("涨幅处在隔夜可博弈区间: %.2f%%", pct)),
        Rule(core & (pct <= 6.5), high=8.0, note=_say("涨幅未进入过度一致区")),
        Rule(core & (pct > 6.5), high=2.0, risk=_say("涨幅偏接近一致区，需要更强的晚间催化")),
        Rule(top, 18.0, 10.0, -8.0, risk=_say("涨幅偏高，次日兑现压力增加: %.2f%%", pct)),
        Rule(low, 6.0, 5.0, 4.0, _say("涨幅不高，若有催化仍有补涨空间: %.2f%%", pct)),
        Rule(~(core | top | low), high=-8.0, risk=_say("涨幅不在隔夜优选区间: %.2f%%", pct)),
        Rule(lit(True), cap(amount / 1e9, 8) * 2.2, cap(amount / 1e9, 6) * 1.5),
        Rule(amount >= 1e9, reason=_say("成交额充足: %.1f亿", amount / YI)),
        Rule(lit(True), cap(turnover, 18) * 0.75),
        Rule(turnover.between(2, 15), accept=8.0, high=7.0, reason=_say("换手相对健康: %.2f%%", turnover)),
        Rule(turnover > 20, high=-8.0, risk=_say("换手过高，筹码分歧较大: %.2f%%", turnover)),
        Rule(vr >= 1, vol, cap(vol, 12), cap(vol, 8), _say("量比放大: %.2f", vr)),
        Rule(speed > 0, up, up, cap(up, 10), _say("尾盘/盘口涨速为正: %.2f", speed)),
        Rule(speed < -1, high=-6.0, risk=_say("涨速转弱: %.2f", speed)),
        Rule(chg5 > 0, up5, up5, cap(up5, 8), _say("5分钟动量为正: %.2f%%", chg5)),
        Rule(chg5 < -1, high=-6.0, risk=_say("5分钟动量走弱: %.2f%%", chg5)),
        Rule(cp >= 0.75, accept=6.0, high=10.0, note=_say("收盘接近全天高位，尾盘承接更像主动拿隔夜")),
        Rule((cp > 0) & (cp < 0.55), high=-10.0, risk=_say("收盘离全天高位较远，明早高开难度提高")),
        Rule(amp.between(3, 10), accept=4.0),
        Rule(amp > 12, high=-6.0, risk=_say("振幅过大，隔夜不确定性提高: %.2f%%", amp)),
        Rule(net > 0, inflow, cap(inflow, 18), cap(inflow, 16), _say("主力资金净流入: %.1f亿", net / YI), source=_say("资金流净买入延续")),
        Rule(net < -YI, high=-10.0, risk=_say("主力资金净流出: %.1f亿", net / YI)),
        Rule(net_pct > 3, cap(net_pct, 12), cap(net_pct, 10), cap(net_pct, 8)),
        Rule(c("previous_limit").isNotNull(), 8.0, 10.0, 9.0, _say("昨日涨停池仍有辨识度"), source=_say("昨日强势辨识度资金")),
        Rule(c("strong").isNotNull(), 7.0, 7.0, 7.0,
             F.concat(lit("强势池: "), F.coalesce(F.nullif(c("strong.reason"), lit("")), lit("入选"))), source=_say("强势池趋势资金")),
        Rule(c("broken").isNotNull(), -16.0, -12.0, -16.0, risk=_say("曾炸板，分歧和兑现压力需要重点确认")),
        Rule(warmth > 0, warmth, cap(warmth * 0.6, 10), cap(warmth * 0.5, 9), F.concat(lit("板块池热度靠前: "), c("industry")),
             source=F.concat(c("industry"), lit("板块延续资金"))),
        Rule(hot, high=-10.0, risk=F.concat(c("industry"), lit("板块热度偏高潮，明早轮动/兑现风险高"))),
        Rule(pct >= 8.8, accept=-8.0, high=-12.0, risk=_say("接近涨停，明早兑现压力偏大")),
        Rule(amount < YI, -10.0, 0.0, -10.0, risk=_say("成交额不足，流动性不适合作为优先隔夜标的")),
        Rule((breadth != 0) & (breadth < 0.25), accept=-10.0, high=-20.0, risk=_say("全市场宽度极弱，隔夜高开需要明显新增催化")),
        Rule((breadth >= 0.25) & (breadth < 0.35), accept=-7.0, high=-14.0, risk=_say("全市场宽度偏弱，不能只因今日板块强就主推")),
        Rule(broken_ratio > 0.30, high=-8.0, risk=_say("炸板比例偏高，说明情绪分歧和次日兑现压力较大")),
    ]
    return rules, rotation


def score_candidates(df: DataFrame) -> DataFrame:
    """Scores, grade and notes of every candidate row.

    Input: compact stock columns, optional structs ``flow``, ``previous_limit``, ``strong``, ``broken`` and ``heat``,
    ``industry``, ``market_breadth`` and ``broken_limit_ratio``.
    """
    df = resolved_inputs(df)
    rules, rotation = _rules()

    def total(field: str) -> Column:
        parts = []
        for r in rules:
            v = getattr(r, field)
            if isinstance(v, Column) or v:
                parts.append(F.when(holds(r.cond), v if isinstance(v, Column) else F.lit(v)).otherwise(F.lit(0.0)))
        return reduce(lambda a, b: a + b, parts)

    def notes(field: str, size: int | None) -> Column:
        cells = [F.when(holds(r.cond), getattr(r, field)) for r in rules if getattr(r, field) is not None]
        kept = F.filter(F.array(*cells), lambda x: x.isNotNull())
        return F.slice(kept, 1, size) if size else kept

    df = df.withColumns(
        {"_s": total("score"), "_a": total("accept"), "_h": total("high"), "rotation_risk": rotation, "_src": notes("source", None), "_risk": notes("risk", None)}
    )
    orphan = F.size("_src") == 0
    carried = F.col("_h") + F.least(F.greatest(F.col("_a"), F.lit(0.0)), F.lit(70.0)) * 0.45 + F.when(orphan, F.lit(-8.0)).otherwise(F.lit(0.0))
    bound = lambda e: F.greatest(F.least(e, F.lit(100.0)), F.lit(0.0))
    all_risks = F.when(orphan, F.concat("_risk", F.array(F.lit("缺少明确明早新增资金来源，必须有新闻/政策再确认")))).otherwise(F.col("_risk"))
    df = df.withColumns(
        {
            "market_score": F.round(F.greatest(F.col("_s"), F.lit(0.0)), 2),
            "next_day_accept_score": F.round(bound(F.col("_a")), 2),
            "high_open_score": F.round(bound(carried), 2),
            "next_day_fund_sources": F.slice("_src", 1, 6),
            "high_open_reasons": notes("note", 6),
            "score_reasons": notes("reason", 8),
            "risk_notes": F.slice(all_risks, 1, 8),
        }
    )
    high, accept = F.col("high_open_score"), F.col("next_day_accept_score")
    grade = (
        F.when((high >= 70) & (accept >= 60) & (F.col("rotation_risk") != "high"), "priority")
        .when((high >= 55) & (accept >= 50), "watch").otherwise("avoid")
    )
    return df.withColumns(
        {
            "execution_grade": grade,
            "requires_news_catalyst": (high < 70) | (F.col("rotation_risk") == "high"),
            "close_position": F.round("close_position", 4),
        }
    ).drop("_s", "_a", "_h", "_src", "_risk")
