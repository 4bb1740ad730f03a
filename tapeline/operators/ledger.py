"""Holdings as a fold over an append-only trade log.

A trade moves the held quantity x by a map max(x + a, b), or sets it, and such maps compose to one of the same form. So the
log is cut into ranges of about equal size; each range is one pass that composes the maps of a key from its start, and a single
row for each range carries what came before it. The quantity before every trade follows, and with it what was rejected and
where a position was opened, set anew or sold out.

The average cost is rounded after every buy, so the trades of one position must be applied in order. Only those that still
count are: for each key those after it was last sold out, or from the last correction that sets quantity and cost. They are
streamed through sorted partitions with constant state.

A correction of one number where nothing is held opens a position with an unknown one, which no such map describes. Trades of keys with
one are cut into runs that begin at each sale of everything and each correction of both numbers. Nothing before a run matters in it, so
only the runs that hold such a correction, and the last of a key, are applied trade by trade; the others follow from the quantities.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.operators.scaling import composed_moves
from tapeline.session import staged

KEY = ["account", "code"]
RUN = "account bigint, code string, run bigint, name string, quantity bigint, average_cost double, opened_at timestamp_ntz, last_updated_at timestamp_ntz, held boolean, afresh boolean, first_at timestamp_ntz, trades bigint, rejected bigint"


def apply_trade(position: dict | None, side: str, quantity: int | None, price: float | None, name: str, at) -> tuple[dict | None, bool]:
    """One step of the ledger: (new position, accepted). ``None`` means no position or an unknown number."""
    bad = (quantity is not None and quantity <= 0) or (price is not None and price <= 0 and side != "sell")
    if bad:
        return position, False
    if side == "sell":
        held = position["quantity"] if position else None
        if position is None or (quantity is not None and held is None):
            return position, False
        if quantity is None or quantity >= held:
            return None, True
        return {**position, "quantity": held - quantity, "updated": at}, True
    if side == "buy":
        if quantity is None or price is None:
            return position, False
        if position is not None:
            if position["quantity"] is None or position["cost"] is None:
                return position, False
            old = position["quantity"]
            price = round((old * position["cost"] + quantity * price) / (old + quantity), 4)
            quantity = old + quantity
    if position is None:
        return {"name": name, "quantity": quantity, "cost": price, "opened": at, "updated": at}, True
    return {
        **position, "name": name, "updated": at,
        "quantity": position["quantity"] if quantity is None else quantity,
        "cost": position["cost"] if price is None else price,
    }, True


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted trades; emits one row per (account, code, run). ``afresh``: nothing was held at some point of the run."""
    names, key, done = [f.split()[0] for f in RUN.split(", ")], None, []
    position, trades, rejected, afresh, first_at = None, 0, 0, False, None

    def close() -> tuple:
        p = position or {}
        return (*key, p.get("name"), p.get("quantity", 0 if position is None else None), p.get("cost"), p.get("opened"), p.get("updated"), position is not None, afresh, first_at, trades, rejected)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        whole, stamp = pa.int64(), pa.timestamp("us")
        kinds = [whole, pa.string(), whole, pa.string(), whole, pa.float64(), stamp, stamp, pa.bool_(), pa.bool_(), stamp, whole, whole]
        return pa.record_batch([pa.array(c, whole).cast(k) if k == stamp else pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)) for c in (*KEY, "run", "side", "quantity", "price", "name", "at")]
        columns[-1] = columns[-1].cast(pa.int64())  # microseconds; plain numbers are quicker than times
        columns = [c.to_pylist() for c in columns]
        for account, code, run, side, quantity, price, name, at in zip(*columns):
            if (account, code, run) != key:
                if key is not None:
                    done.append(close())
                resets = side not in ("sell", "buy") and (quantity or 0) > 0 and (price or 0) > 0
                key, position, trades, rejected, afresh, first_at = (account, code, run), None, 0, 0, not resets, at
            position, accepted = apply_trade(position, side, quantity, None if price is None or price != price else price, name, at)
            trades, rejected, afresh = trades + 1, rejected + (not accepted), afresh or position is None
        if done:
            yield packed(done)
            done = []
    if key is not None:
        yield packed([close()])


def _kinds() -> dict[str, Column]:
    """What a trade does, by its own numbers: null-safe conditions."""
    side, quantity, price = F.col("side"), F.col("quantity"), F.when(~F.isnan("price"), F.col("price"))
    bad = F.coalesce((quantity <= 0) | ((price <= 0) & (side != "sell")), F.lit(False))
    sell, buy = ~bad & (side == "sell"), ~bad & (side == "buy")
    fix = ~bad & ~side.isin("sell", "buy")
    whole = quantity.isNotNull() & price.isNotNull()
    return {
        "bad": bad, "sell": sell, "all": sell & quantity.isNull(), "buy": buy & whole, "halfbuy": buy & ~whole,
        "reset": fix & whole, "sets": fix & quantity.isNotNull(), "partial": fix & ~whole,
    }


def moved(trades: DataFrame) -> DataFrame:
    """Each trade with ``held`` (the quantity before it), ``_place`` (which rises along a key's trades) and ``sold_out`` and ``resets`` (how many sales of
    everything and corrections of both numbers its key had before it). ``held`` is right up to a key's first ``partial``
    correction where nothing is held, and again after the next sale of everything or correction of both numbers.
    """
    k, n = _kinds(), F.col("quantity")
    add = F.when(k["sell"], -n).when(k["buy"], n).otherwise(0)
    low = F.when(k["buy"] | k["sets"], n).otherwise(0)
    flat = k["all"] | k["sets"]  # the quantity after it does not depend on the one before
    counts = {"sold_out": k["all"].cast("bigint"), "resets": k["reset"].cast("bigint")}
    return composed_moves(trades, KEY, ["seq"], F.coalesce(add, F.lit(0)), F.coalesce(low, F.lit(0)), flat, "held", counts, "trades")


def runs_by_quantities(rows: DataFrame) -> DataFrame:
    """What ``_fold`` tells of each run but name, numbers and last time, and ``_asked``: whether it must be applied to know it.

    In a run that holds no correction of an unknown position the quantity before every trade but the first is right; a first one
    with another before it is a correction of both numbers, which is never rejected.
    """
    runs = rows.groupBy(*KEY, "run", "_last_run").agg(
        F.count(F.lit(1)).alias("trades"), F.sum(F.col("_rejected").cast("bigint")).alias("rejected"), F.max("_unknown").alias("_odd_run"),
        F.max(F.col("_after") == 0).alias("_nothing"), F.min_by("_reset", "_place").alias("_resets"), F.max_by(F.col("_after") > 0, "_place").alias("held"),
        F.min_by("at", "_place").alias("first_at"), F.max_by("at", F.when(F.col("_opens"), F.col("_place"))).alias("opened_at"),
    )
    asked, afresh = F.col("_odd_run") | (F.col("run") == F.col("_last_run")), F.col("_nothing") | ~F.col("_resets")
    opened = F.when(F.col("held"), F.col("opened_at"))
    return runs.select(*KEY, "run", "trades", "rejected", "held", afresh.alias("afresh"), "first_at", opened.alias("opened_at"), asked.alias("_asked"))


def holdings(trades: DataFrame) -> DataFrame:
    """Final position per (account, code) and the number of trades and of rejected ones.

    ``trades``: account, code, name, seq (total order), side buy|sell|upsert, quantity, price, at. A quantity or price may be
    null (unknown): such a sell sells everything, such a buy is rejected, such an upsert leaves the number as it is. Trades without an
    account or a code are left out.
    """
    named = trades.where(F.col("account").isNotNull() & F.col("code").isNotNull())
    rows = moved(named.withColumn("account", F.col("account").cast("bigint")))
    k, held, n = _kinds(), F.col("held"), F.col("quantity")
    after = F.when(k["all"], 0).when(k["sell"], F.greatest(held - n, F.lit(0))).when(k["buy"], held + n).when(k["sets"], n).otherwise(held)
    rejected = k["bad"] | (k["sell"] & (held == 0)) | k["halfbuy"]
    rows = rows.withColumns({
        "_after": after, "_rejected": rejected, "_unknown": k["partial"] & (held == 0), "_reset": k["reset"], "_opens": (held == 0) & (after > 0),
    })
    run = F.col("sold_out") + F.col("resets") + F.col("_reset").cast("bigint")
    keys = staged(rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("trades"), F.sum(F.col("_rejected").cast("bigint")).alias("rejected"), F.max("_unknown").alias("_odd"),
        F.max(F.when(F.col("_after") == 0, F.col("_place"))).alias("_none"), F.max(F.when(F.col("_reset"), F.col("_place"))).alias("_set"),
        F.max_by("at", F.when(F.col("_opens"), F.col("_place"))).alias("_opened"), F.max(run).alias("_last_run"),
    ), "ledger-keys")
    rows = rows.join(keys.select(*KEY, "_odd", "_none", "_set", "_last_run"), KEY)
    since = (F.col("_none").isNull() | (F.col("_place") > F.col("_none"))) & (F.col("_set").isNull() | (F.col("_place") >= F.col("_set")))
    rows = rows.withColumn("run", F.when(F.col("_odd"), run).otherwise(0))
    each = staged(runs_by_quantities(rows.where("_odd")), "ledger-each")
    asked = staged(each.where("_asked").select(*KEY, "run", "_asked"), "ledger-asked")
    slim = rows.join(asked, [*KEY, "run"], "left").where(F.col("_asked") | (~F.col("_odd") & since))
    order = [*KEY, "run", "_place"]
    slim = slim.select(*order, "side", "quantity", "price", "name", "at")
    applied = staged(slim.repartition(*KEY, "run").sortWithinPartitions(*order).drop("_place").mapInArrow(_fold, RUN), "ledger-runs")
    folded = applied.unionByName(each.where(~F.col("_asked")).drop("_asked"), allowMissingColumns=True)
    # a run that begins with a correction and never holds nothing goes on with the position of the run before it
    state = F.struct("name", "quantity", "average_cost", "last_updated_at", "held")
    last = folded.groupBy(*KEY).agg(
        F.max_by(state, "run").alias("_p"), F.sum("rejected").alias("_rejected"), F.max("run").alias("_last"),
        F.max(F.when(F.col("afresh"), F.col("run"))).alias("_afresh"), F.max_by("opened_at", F.when(F.col("afresh"), F.col("run"))).alias("_opened_in"),
        F.max_by("held", F.when(F.col("afresh"), F.col("run"))).alias("_kept"),
    )
    # the first run after the last one that ended with nothing, or the very first
    heirs = folded.join(last.select(*KEY, "_afresh", "_kept"), KEY).where(F.col("_afresh").isNull() | (F.col("run") > F.col("_afresh")))
    heirs = heirs.groupBy(*KEY).agg(F.min_by("first_at", "run").alias("_inherited"))
    out = keys.join(last, KEY, "left").join(heirs, KEY, "left")
    opened = F.when(~F.col("_odd"), F.col("_opened")).when(F.coalesce("_kept", F.lit(False)), F.col("_opened_in")).otherwise(F.col("_inherited"))
    return out.select(
        *KEY, F.col("_p.name").alias("name"), F.when(F.col("_p").isNull(), 0).otherwise(F.col("_p.quantity")).alias("quantity"), F.col("_p.average_cost").alias("average_cost"),
        F.when(F.coalesce("_p.held", F.lit(False)), opened).alias("opened_at"), F.col("_p.last_updated_at").alias("last_updated_at"),
        "trades", F.when(F.col("_odd"), F.col("_rejected")).otherwise(F.col("rejected")).alias("rejected"),
    )


def open_positions(held: DataFrame) -> DataFrame:
    return held.where(F.col("quantity").isNull() | (F.col("quantity") > 0))
