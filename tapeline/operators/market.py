"""Market cross-sections: universes, summaries, pools, ranked lists and the snapshot catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions import codes, constants
from tapeline.functions.hashing import digest
from tapeline.functions.numbers import first_text, holds, num0, num_null_finite
from tapeline.functions.times import minutes_of_day
from tapeline.operators.scaling import latest_by, top_n

STOCK_COLUMNS = (
    "code", "name", "price", "pct", "amount", "turnover", "volume_ratio", "amplitude", "speed", "change_5m",
    "float_cap", "total_cap", "high", "low", "open", "prev_close",
)
BOARD_COLUMNS = ("code", "name", "pct", "amount", "turnover", "rise_count", "fall_count", "leader", "leader_pct")
FLOW_COLUMNS = ("code", "name", "pct", "main_net", "main_net_pct", "super_net", "big_net")
POOL_COUNTS = {
    "limit_up": "limit_up_count",
    "previous_limit_up": "previous_limit_count",
    "strong": "strong_count",
    "broken_limit": "broken_limit_count",
}


def tradeable_universe(spot: DataFrame, allow_chinext: bool = False) -> DataFrame:
    """Rows of tradeable boards; risk-marked and delisting names are out."""
    return spot.where(codes.is_tradeable("code", "name", allow_chinext))


def main_board_universe(spot: DataFrame) -> DataFrame:
    return spot.where(codes.is_main_board("code", "name"))


def _number(df: DataFrame, name: str) -> Column:
    """Zero for what is missing. Columns that are already numeric skip the text parser."""
    if name not in df.columns:
        return F.lit(0.0)
    kind = dict(df.dtypes)[name]
    return num0(name) if kind == "string" else F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def compact_stocks(spot: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Quote rows cut to the published columns, numbers cleaned to zero."""
    price = "price" if "price" in spot.columns else "close"
    cols = [F.col(k) for k in keys]
    for c in STOCK_COLUMNS:
        if c == "code":
            cols.append(codes.clean_code("code").alias("code"))
        elif c == "name":
            cols.append(codes.clean_name("name").alias("name"))
        else:
            cols.append(_number(spot, price if c == "price" else c).alias(c))
    return spot.select(*cols)


def compact_boards(boards: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return boards.select(
        *keys,
        *[
            (first_text(c) if c in ("code", "name", "leader") else _number(boards, c)).alias(c)
            for c in BOARD_COLUMNS
        ],
    )


def compact_flows(flows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return flows.select(
        *keys,
        codes.clean_code("code").alias("code"),
        codes.clean_name("name").alias("name"),
        *[_number(flows, c).alias(c) for c in FLOW_COLUMNS[2:]],
    )


def market_summary(spot: DataFrame, pools: DataFrame, key: str = "snapshot_id", allow_chinext: bool = False) -> DataFrame:
    """Counts, breadth and broken-limit ratio per snapshot."""
    pct = _number(spot, "pct")
    stocks = spot.groupBy(key).agg(
        F.count(F.lit(1)).alias("stock_count"),
        F.count_if(codes.is_tradeable("code", "name", allow_chinext)).alias("tradeable_stock_count"),
        F.count_if(pct > 0).alias("up_count"),
        F.count_if(pct < 0).alias("down_count"),
    )
    limits = pools.groupBy(key).agg(
        F.count_if(F.col("pool") == "limit_up").alias("limit_up_count"),
        F.count_if(F.col("pool") == "broken_limit").alias("broken_limit_count"),
    )
    both = stocks.join(limits, key, "left").fillna(0, ["limit_up_count", "broken_limit_count"])
    share = lambda a, total: F.round(a / F.greatest(total, F.lit(1)), 4)
    return both.withColumns(
        {
            "market_breadth": share(F.col("up_count"), F.col("up_count") + F.col("down_count")),
            "broken_limit_ratio": share(F.col("broken_limit_count"), F.col("limit_up_count") + F.col("broken_limit_count")),
        }
    )


def pool_industry_counts(pools: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """Pool members per industry, hottest first (``rank`` holds the order)."""
    counts = (
        pools.where(F.coalesce("industry", F.lit("")) != "")
        .groupBy(key, "industry")
        .agg(*[F.count_if(F.col("pool") == p).alias(c) for p, c in POOL_COUNTS.items()])
    )
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*_heat_order())))


def _heat_order() -> list[Column]:
    return [
        F.desc("limit_up_count"), F.desc("previous_limit_count"), F.desc("strong_count"),
        F.asc("broken_limit_count"), F.asc("industry"),
    ]


def pool_industry_leaders(pools: DataFrame, key: str = "snapshot_id", leaders: int = 8, limit: int = 100) -> DataFrame:
    """Industry counts with their first members in pool order.

    Leaders are cut to ``leaders`` per industry before anything is gathered.
    """
    member = pools.where(F.coalesce("industry", F.lit("")) != "")
    pool_no = F.array_position(F.array(*[F.lit(p) for p in POOL_COUNTS]), F.col("pool"))
    first = top_n(member.withColumn("_p", pool_no), [key, "industry"], [F.asc("_p"), F.asc("seq")], leaders, "_r")
    lists = first.groupBy(key, "industry").agg(
        F.sort_array(F.collect_list(F.struct("_r", "code", "name", "pct"))).alias("_l")
    )
    lists = lists.select(
        key, "industry", F.transform("_l", lambda x: F.struct(x["code"].alias("code"), x["name"].alias("name"), x["pct"].alias("pct"))).alias("leaders")
    )
    ranked = pool_industry_counts(pools, key).where(F.col("rank") <= limit)
    return ranked.join(lists, [key, "industry"])


# Ranked lists of one snapshot: list name -> (frame, order column, size).
RANKED_LISTS = {
    "top_gainers": ("stock", "pct", 50),
    "top_amount": ("stock", "amount", 50),
    "top_turnover": ("stock", "turnover", 50),
    "top_volume_ratio": ("stock", "volume_ratio", 50),
    "top_industries": ("industry_board", "pct", 50),
    "top_concepts": ("concept_board", "pct", 80),
    "top_industry_fund_flow": ("industry_flow", "main_net", 50),
    "top_concept_fund_flow": ("concept_flow", "main_net", 80),
    "top_stock_fund_flow": ("stock_flow", "main_net", 100),
}
# Sizes of the scoring variant where they differ.
SCORING_LIST_SIZES = {
    "top_industries": 30, "top_concepts": 50, "top_industry_fund_flow": 30, "top_concept_fund_flow": 50, "top_stock_fund_flow": 80,
}


def ranked_lists(
    frames: dict[str, DataFrame], key: str = "snapshot_id", allow_chinext: bool = False, sizes: dict[str, int] | None = None
) -> DataFrame:
    """All ranked lists as rows (snapshot, list, rank, code, name, value); ties go by code.

    The four stock lists share one scan: the row is unpivoted into its lists before ranking.
    """
    parts = []
    for frame in dict.fromkeys(f for f, _, _ in RANKED_LISTS.values()):
        if frame not in frames:
            continue
        df = frames[frame]
        if frame == "stock":
            df = tradeable_universe(df, allow_chinext)
        entries = [
            F.struct(F.lit(name).alias("list"), _number(df, col).alias("value"), F.lit((sizes or {}).get(name, n)).alias("size"))
            for name, (f, col, n) in RANKED_LISTS.items()
            if f == frame
        ]
        parts.append(
            df.select(key, first_text("code").alias("code"), first_text("name").alias("name"), F.explode(F.array(*entries)).alias("e"))
            .select(key, "e.list", "code", "name", "e.value", "e.size")
        )
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    largest = max((sizes or {}).get(n, s) for n, (_, _, s) in RANKED_LISTS.items())
    best = top_n(rows, [key, "list"], [F.desc("value"), F.asc("code")], largest)
    return best.where(F.col("rank") <= F.col("size")).drop("size")


def pool_by_code(pools: DataFrame, pool: str, key: str = "snapshot_id") -> DataFrame:
    """One row per code of a pool; the last duplicate wins."""
    return latest_by(pools.where((F.col("pool") == pool) & (F.col("code") != "")), [key, "code"], "seq")


def with_pools_and_flow(stocks: DataFrame, flow: DataFrame, pools: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """Stocks with optional structs ``flow``, ``previous_limit``, ``strong`` and ``broken`` looked up by code.

    The three pools are folded into one row per code first, so stocks are joined twice, not four times.
    """
    member = F.struct("turnover", "speed", "amplitude", "volume_ratio", "industry", "reason")
    cells = pools.where(F.col("code") != "").groupBy(key, "code").agg(
        *[
            F.max_by(F.when(F.col("pool") == p, member), F.when(F.col("pool") == p, F.col("seq"))).alias(name)
            for p, name in (("previous_limit_up", "previous_limit"), ("strong", "strong"), ("broken_limit", "broken"))
        ]
    )
    flows = compact_flows(flow, [key]).where(F.col("code") != "")
    flows = flows.select(key, "code", F.struct("main_net", "main_net_pct").alias("flow"))
    return stocks.join(flows, [key, "code"], "left").join(cells, [key, "code"], "left")


def source_status(frames: DataFrame, key: str = "snapshot_id", expected: Sequence[str] = constants.FRAMES) -> DataFrame:
    """Per snapshot and expected frame: ok, row count, error. ``frames`` holds (key, frame, error, n_rows)."""
    seen = frames.groupBy(key, "frame").agg(F.sum("n_rows").alias("rows"), F.max("error").alias("error"))
    wanted = frames.select(key).distinct().withColumn("frame", F.explode(F.array(*[F.lit(f) for f in expected])))
    out = wanted.join(seen, [key, "frame"], "left")
    return out.select(
        key, "frame",
        (F.col("rows").isNotNull() & F.col("error").isNull()).alias("ok"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.when(F.col("rows").isNull(), F.coalesce("error", F.lit("missing"))).otherwise(F.col("error")).alias("error"),
    )


# --- snapshot catalogue -------------------------------------------------------------------------------


def is_valid_snapshot(spot_ok="spot_ok", stock_count="stock_count", tradeable="tradeable_stock_count", window_valid="window_valid") -> Column:
    return (
        holds(F.col(spot_ok)) & holds(F.col(stock_count) > 1000) & holds(F.col(tradeable) > 500)
        & F.coalesce(F.col(window_valid), F.lit(True))
    )


def is_complete_snapshot(minimum_stocks: int, source_time="source_time", captured_at="captured_at") -> Column:
    """Close data: historical, or taken at 14:55 or later."""
    clock = minutes_of_day(F.coalesce(F.col(source_time), F.col(captured_at)))
    at_close = (F.col("mode") == "historical") | F.coalesce(clock >= 14 * 60 + 55, F.lit(False))
    return holds(F.col("stock_count") >= minimum_stocks) & F.coalesce(F.col("window_valid"), F.lit(True)) & at_close


def admitted(snapshots: DataFrame, minimum: int = 1000) -> DataFrame:
    return snapshots.where(F.coalesce("stock_count", F.lit(0)) >= minimum)


def snapshot_listing(snapshots: DataFrame, market_date: str = "", mode: str = "") -> DataFrame:
    out = snapshots
    if market_date:
        out = out.where(F.replace(F.col("market_date"), F.lit("-"), F.lit("")) == market_date.replace("-", ""))
    return out.where(F.col("mode") == mode) if mode else out


def snapshot_index(snapshots: DataFrame) -> DataFrame:
    """One entry per id; a permanent file beats a "latest" copy; rows without an id get a legacy one."""
    captured = F.col("captured_at").cast("string")
    legacy = F.concat(F.lit("legacy_"), digest(F.col("mode"), captured, length=16))
    ided = admitted(snapshots).withColumn("snapshot_id", F.coalesce(F.nullif(F.col("snapshot_id"), F.lit("")), legacy))
    order = F.struct(F.col("is_latest_file"), F.col("seq"))
    return latest_by(ided, ["snapshot_id"], order, newest=False).withColumn(
        "is_complete", F.coalesce(F.col("window_valid"), F.lit(True))
    )


def latest_per_mode(index: DataFrame) -> DataFrame:
    return latest_by(index, ["mode"], F.struct("captured_at", "snapshot_id"))


def latest_per_day(index: DataFrame) -> DataFrame:
    return latest_by(index, ["market_date"], F.struct("captured_at", "snapshot_id"))


def largest_file_per_day(files: DataFrame, day: str = "session", size: str = "n_rows", seq: str = "path") -> DataFrame:
    """The fullest file of a day; the first path wins a tie."""
    best = files.groupBy(day).agg(F.max(size).alias(size))
    return latest_by(files.join(best, [day, size], "left_semi"), [day], seq, newest=False)


def public_snapshot(index: DataFrame) -> DataFrame:
    return index.drop("path")


def choose_snapshot(index: DataFrame, mode: str) -> DataFrame:
    """Newest usable snapshot for a decision mode; falls back to complete ones of any mode.

    Only one row per mode leaves the big aggregate, so the choice itself is over at most a handful of rows.
    """
    market_day = F.coalesce(
        F.nullif(F.replace(F.col("market_date"), F.lit("-"), F.lit("")), F.lit("")),
        F.replace(F.substring(F.col("source_time").cast("string"), 1, 10), F.lit("-"), F.lit("")),
        F.lit(""),
    )
    wanted = F.col("mode").isin("overnight", "custom") if mode == "overnight" else F.col("mode").isin("morning", "midday", "overnight", "custom")
    key = F.struct(
        market_day.alias("d"), F.coalesce(F.col("source_time").cast("string"), F.lit("")).alias("s"),
        F.coalesce(F.col("captured_at").cast("string"), F.lit("")).alias("c"), F.col("snapshot_id").alias("i"),
    )
    per_mode = latest_by(index.where(F.col("snapshot_id").isNotNull()), ["mode"], F.struct("captured_at", "snapshot_id")).where(wanted)
    complete = latest_by(index.where("is_complete").withColumn("_one", F.lit(1)), ["_one"], key).drop("_one")
    both = per_mode.withColumn("_tier", F.lit(2)).unionByName(complete.withColumn("_tier", F.lit(1)))
    return latest_by(both.withColumn("_one", F.lit(1)), ["_one"], F.struct(F.col("_tier"), key)).drop("_one", "_tier")


def numeric_observation(spot: DataFrame) -> DataFrame:
    """Rows whose four prices are all positive."""
    return spot.where(F.least(*[_number(spot, c) for c in ("open", "high", "low", "close")]) > 0)


def feature_screen(
    features: DataFrame, min_amount=None, min_pct=None, max_pct=None, min_turnover=None, max_range_position=None
) -> DataFrame:
    """Screen on features; a missing value counts as zero, except that range position must be known."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    out = features
    for limit, cond in (
        (min_amount, lambda v: zero("amount") >= v),
        (min_pct, lambda v: zero("pct") >= v),
        (max_pct, lambda v: zero("pct") <= v),
        (min_turnover, lambda v: zero("turnover") >= v),
        (max_range_position, lambda v: F.col("range_position_15d") <= v),
    ):
        if limit is not None:
            out = out.where(cond(limit))
    return out


def screen_page(matches: DataFrame, sort_by: str, ascending: bool = False, limit: int = 50, ties: Sequence[str] = ("code",)) -> DataFrame:
    """First ``limit`` matches in order, each with the total number of matches."""
    value = F.coalesce(F.col(sort_by), F.lit(0.0))
    total = matches.groupBy().count().withColumnRenamed("count", "total_matches")
    page = matches.orderBy(value.asc() if ascending else value.desc(), *[F.col(t).asc() for t in ties]).limit(limit)
    return page.withColumn("total_matches", total.scalar())


def vendor_columns(raw: DataFrame, kind: str, keep: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Vendor field codes to named columns; text fields stay text, the rest become numbers."""
    mapping = constants.VENDOR_FIELDS[kind]
    return raw.select(
        *keep,
        *[
            (F.col(f).cast("string") if c in constants.TEXT_FIELDS else num_null_finite(f)).alias(c)
            for c, f in mapping.items()
            if columns is None or c in columns
        ],
    )
