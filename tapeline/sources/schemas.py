"""Schemas of the stored tables."""

from __future__ import annotations

_TEXT = "source title content summary url publish_time crawled_at crawled_at_source stock_code stock_name announcement_type level".split()
_LISTS = "tags plate plates keywords matched_keywords source_urls".split()
_NORMALIZED = (
    "publish_time_bj publish_time_bj_display publish_date_bj time_parse_note collected_at crawled_at_display crawled_date_bj "
    "crawl_time_note latency_note source_time"
).split()

NEWS = ", ".join(
    [f"{c} string" for c in _TEXT] + [f"{c} array<string>" for c in _LISTS] + [f"{c} string" for c in _NORMALIZED]
    + ["time_normalized boolean", "latency_minutes double"]
)

# Quotes arrive as text, number or "-", so every field is read as text and cleaned afterwards.
QUOTE_NAMES = {
    "code": "代码", "name": "名称", "last_price": "最新价", "close": "收盘", "open_price": "今开", "open": "开盘", "high": "最高", "low": "最低",
    "prev_close": "昨收", "pct": "涨跌幅", "amount": "成交额", "volume": "成交量", "turnover": "换手率", "volume_ratio": "量比", "amplitude": "振幅",
    "speed": "涨速", "change_5m": "5分钟涨跌", "main_net": "主力净流入", "float_cap": "流通市值", "total_cap": "总市值", "industry": "所属行业",
}
QUOTE = ", ".join(f"`{v}` string" for v in QUOTE_NAMES.values())
SNAPSHOT = (
    "metadata struct<snapshot_id: string, mode: string, captured_at: string, source_time: string, market_date: string, window_valid: boolean>, "
    "derived struct<summary: struct<stock_count: bigint, tradeable_stock_count: bigint>>, "
    f"raw struct<stock_spot: array<struct<{QUOTE.replace(' string', ': string')}>>>"
)
CALENDAR = "source string, fetched_at string, trade_dates array<string>"
OVERRIDES = "source string, covered_years array<int>, closed_dates array<string>, open_dates array<string>"
WATCHLIST = (
    "watchlist array<struct<rank: int, code: string, name: string, status: string, theme: string, chokepoint_node: string, serenity_reason: string, "
    "market_confirmation: struct<price: double, pct: double, amount_billion_yuan: double, pool: string>, evidence_level: string, confidence: string, "
    "required_follow_up: array<string>, risk_notes: array<string>>>"
)
SOCIAL_RAW = (
    "platform string, source_name string, source_url string, focus string, fetched_at string, fetch_status string, tool_used string, "
    "raw_text string, raw_json string, error string"
)
