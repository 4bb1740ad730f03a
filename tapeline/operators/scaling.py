"""Building blocks that stay exact and parallel when one key holds much of the data.

* ``percentile_rank``  cross-sectional rank without a per-group window over raw rows
* ``ordered_totals``   running totals in two levels: inside small buckets, then across bucket sums
* ``composed_moves``   a value moved by max(x + a, b) or set, row after row: one pass per range and a row to carry over
* ``neighbours``       first / previous value per row in two levels
* ``latest_by``        newest record per key by a map-side combining aggregate
* ``top_n``            best rows per group; Spark cuts each task to ``n`` rows before the shuffle
* ``once``             columns that later conditions use without computing them again
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tapeline.session import staged


def order_bucket(value: Column, steps: int = 256) -> Column:
    """Integer that never decreases as a double grows: exponent, then ``steps`` slices of the mantissa."""
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    part = F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * steps)
    # Doubles below 2^-1074 do not exist, so the shift keeps the magnitude positive.
    magnitude = (exponent + 1100) * (4 * steps) + part + 2 * steps
    return F.when(value == 0, F.lit(0)).when(value > 0, magnitude).otherwise(-magnitude).cast("long")


def percentile_rank(df: DataFrame, by: Sequence[str], value: str, out: str, reverse: bool = False) -> DataFrame:
    """Share of non-null values in the group that are <= the row's value (``cume_dist`` over the non-null rows).

    Equal values are counted before any shuffle; running counts are taken inside narrow value buckets and the
    few bucket totals of a group are accumulated separately, so no task ever sees a whole group.
    """
    by = list(by)
    v = F.col(value)
    counts = df.where(v.isNotNull()).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_b", order_bucket(F.col("_v")))
    totals = counts.groupBy(*by, "_b").agg(F.sum("_n").alias("_bn"))
    across = Window.partitionBy(*by).orderBy("_b")
    totals = totals.select(
        *by,
        "_b",
        (F.sum("_bn").over(across.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_bn")).alias("_before"),
        F.sum("_bn").over(Window.partitionBy(*by)).alias("_all"),
    )
    inside = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranks = counts.withColumn("_run", F.sum("_n").over(inside)).join(totals, [*by, "_b"])
    share = (F.col("_before") + F.col("_run")) / F.col("_all")
    ranks = ranks.select(*by, F.col("_v").alias(value), (F.lit(1.0) - share if reverse else share).alias(out))
    return df.join(ranks, [*by, value], "left")


def percentile_ranks(
    df: DataFrame, by: Sequence[str], row_key: Sequence[str], specs: Sequence[tuple[str, str, bool]]
) -> DataFrame:
    """Several ranks of one cross-section in a single pass; ``by`` plus ``row_key`` identify a row.

    Fields are unpivoted and counted together, so the wide rows are shuffled once however many ranks there are.
    """
    by, ident = list(by), [*by, *row_key]
    cells = F.array(*[F.struct(F.lit(i).alias("f"), F.col(v).cast("double").alias("v")) for i, (v, _, _) in enumerate(specs)])
    slim = df.select(*ident, F.explode(cells).alias("_c")).select(*ident, F.col("_c.f").alias("_f"), F.col("_c.v").alias("_v"))
    slim = slim.where(F.col("_v").isNotNull())
    ranked = percentile_rank(slim, [*by, "_f"], "_v", "_share")
    shares = ranked.groupBy(*ident).agg(*[F.max(F.when(F.col("_f") == i, F.col("_share"))).alias(out) for i, (_, out, _) in enumerate(specs)])
    for _, out, reverse in specs:
        if reverse:
            shares = shares.withColumn(out, F.lit(1.0) - F.col(out))
    return df.join(shares, ident, "left")


def range_buckets(df: DataFrame, by: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """Adds ``_bucket``, which never decreases along (``by``, ``order``), and ``_tie``, a last sort key that makes the order unique.

    Buckets are ranges that Spark cuts by the rows it samples, so they hold about equally many rows however dense a key or
    an hour is. The table is stored, as later passes must see the same cuts.
    """
    by_all = [*by, *order, "_tie"]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    return staged(tied.repartitionByRange(*by_all).withColumn("_bucket", F.spark_partition_id().cast("bigint")), label)


def time_bucket(ts: Column, seconds: int = 3600) -> Column:
    """Bucket number of a wall-clock time, in Beijing or any other zone."""
    gap = (ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second").cast("decimal(20,6)")
    return F.floor(gap / seconds).cast("long")


def ordered_totals(
    df: DataFrame, by: Sequence[str], bucket: Column, order: Sequence[Column | str], sums: dict[str, Column]
) -> DataFrame:
    """Running sums per ``by`` in ``order``; ``bucket`` must not decrease along that order.

    Windows run over (key, bucket) and over one row per bucket, so a key with a third of all rows is split.
    """
    by = list(by)
    base = df.withColumn("_b", bucket)
    for name, expr in sums.items():
        base = base.withColumn(f"_in_{name}", expr)
    per_bucket = base.groupBy(*by, "_b").agg(*[F.sum(f"_in_{n}").alias(f"_sum_{n}") for n in sums])
    across = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *by, "_b", *[F.coalesce(F.sum(f"_sum_{n}").over(across), F.lit(0)).alias(f"_off_{n}") for n in sums]
    )
    inside = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for name in sums:
        base = base.withColumn(f"_run_{name}", F.sum(f"_in_{name}").over(inside))
    joined = base.join(offsets, [*by, "_b"])
    for name in sums:
        joined = joined.withColumn(name, F.col(f"_run_{name}") + F.col(f"_off_{name}"))
    return joined.select(*[c for c in df.columns if c not in sums], *sums)


def neighbours(
    df: DataFrame, by: Sequence[str], bucket: Column, order: Column | str, values: Sequence[str]
) -> DataFrame:
    """Adds ``prev_<v>`` and ``first_<v>`` for each value along ``order`` per key, in two levels."""
    by, order = list(by), F.col(order) if isinstance(order, str) else order
    base = df.withColumn("_b", bucket)
    record = F.struct(*[F.col(v) for v in values])
    edges = base.groupBy(*by, "_b").agg(
        F.min_by(record, order).alias("_head"), F.max_by(record, order).alias("_tail")
    )
    across = Window.partitionBy(*by).orderBy("_b")
    edges = edges.select(
        *by,
        "_b",
        F.lag("_tail").over(across).alias("_carry"),
        F.first("_head").over(across.rowsBetween(Window.unboundedPreceding, 0)).alias("_first"),
    )
    inside = Window.partitionBy(*by, "_b").orderBy(order)
    joined = base.withColumn("_lag", F.lag(record).over(inside)).join(edges, [*by, "_b"])
    previous = F.coalesce(F.col("_lag"), F.col("_carry"))
    return joined.select(
        *df.columns,
        *[previous[v].alias(f"prev_{v}") for v in values],
        *[F.col("_first")[v].alias(f"first_{v}") for v in values],
    )


def latest_by(df: DataFrame, by: Sequence[str], order: Column | str, newest: bool = True) -> DataFrame:
    """One whole record per key: the newest (or oldest) by ``order``. Combines map-side; no sort, no window."""
    rest = [c for c in df.columns if c not in by]
    pick = F.max_by if newest else F.min_by
    key = F.col(order) if isinstance(order, str) else order
    out = df.groupBy(*by).agg(pick(F.struct(*[F.col(c) for c in rest]), key).alias("_r"))
    return out.select(*by, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """Best ``n`` rows per group with their rank."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds columns that are computed a single time a row: a filter on one is not moved before it, which would compute it again."""
    added = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*[c for c in df.columns if c not in columns], added)


def ordered_extreme(
    df: DataFrame, by: Sequence[str], bucket: Column, order: Sequence[Column | str], value: Column, out: str, largest: bool = True
) -> DataFrame:
    """Running maximum (or minimum) per key in ``order``, in two levels like ``ordered_totals``; nulls are skipped."""
    by = list(by)
    agg = F.max if largest else F.min
    pick = F.greatest if largest else F.least
    base = df.withColumns({"_b": bucket, "_v": value})
    per_bucket = base.groupBy(*by, "_b").agg(agg("_v").alias("_bv"))
    across = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*by, "_b", agg("_bv").over(across).alias("_carry"))
    inside = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = base.withColumn("_run", agg("_v").over(inside)).join(carry, [*by, "_b"])
    # greatest / least skip nulls.
    return joined.select(*[c for c in df.columns if c != out], pick("_run", "_carry").alias(out))


class MovesInRange:
    """Composes the moves of each key over the sorted rows of one range, batch after batch.

    A move is (flat, add, low): x becomes low if flat, else max(x + add, low). A run of moves without a flat one is again
    such a move: its add is the sum, and its low is the largest of each row's low plus what later rows add.
    """

    def __init__(self, by: Sequence[str], counts: Sequence[str]):
        self.by, self.counts, self.key = list(by), list(counts), None
        self.before = (False, 0, 0)
        self.counted = [0] * len(self.counts)

    def __call__(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        """For each row what its key's rows before it in the range make: flat, add, low and the counts."""
        column = lambda c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
        n, keys = batch.num_rows, [column(c) for c in self.by]
        starts = np.zeros(n, bool)
        for k in keys:
            starts[1:] |= k[1:] != k[:-1]
        first = tuple(k[0] for k in keys)
        goes_on = first == self.key
        starts[0] = True
        # a row before each key's first: what came before, or nothing
        at = np.flatnonzero(starts)
        row = np.arange(n) + np.cumsum(starts)  # places of the rows among all
        flat, add, low = np.zeros(n + len(at), bool), np.zeros(n + len(at), np.int64), np.zeros(n + len(at), np.int64)
        flat[row], add[row], low[row] = column("_flat").astype(bool), column("_add"), column("_low")
        lead = row[at] - 1
        if goes_on:
            flat[0], add[0], low[0] = self.before
        add[flat] = 0
        begins = flat.copy()
        begins[lead] = True
        run = np.cumsum(begins) - 1
        where = np.flatnonzero(begins)
        total = np.cumsum(add)
        summed = total - (total - add)[where][run]
        lowest = total + pd.Series(low - total).groupby(run).cummax().to_numpy()
        is_flat = flat[where][run]
        out = [is_flat[row - 1], summed[row - 1], lowest[row - 1]]
        self.before = (bool(is_flat[-1]), int(summed[-1]), int(lowest[-1]))
        for i, c in enumerate(self.counts):
            each = column(f"_c_{c}").astype(np.int64)
            running = np.cumsum(each) - each
            base = np.repeat(running[at], np.diff(np.append(at, n)))
            got = running - base
            if goes_on:
                got[: at[1] if len(at) > 1 else n] += self.counted[i]
            out.append(got)
            self.counted[i] = int(got[-1] + each[-1])
        self.key = tuple(k[-1] for k in keys)
        return out


def composed_moves(
    df: DataFrame, by: Sequence[str], order: Sequence[str], add: Column, low: Column, flat: Column, out: str, counts: dict[str, Column], label: str
) -> DataFrame:
    """Adds ``out``, a whole number that starts at zero in each key and that every row moves, as it is before the row.

    A row sets it to ``low`` where ``flat``, else to max(``out`` + ``add``, ``low``); it must not fall below zero. ``counts`` are running sums before
    the row, by name. Rows that tie in ``order`` follow their read order. ``_place`` rises along a key's rows in that order. Rows are cut into ranges of about
    equal size along (``by``, ``order``), so a key with any share of all rows is split; each range is sorted and passed once, and stored. What
    came before a range concerns only the key that it starts with, so at most one row for each range is carried over.
    """
    by, totals, named = list(by), list(counts), {"_add": add.cast("bigint"), "_low": low.cast("bigint"), "_flat": F.coalesce(flat, F.lit(False)), **{f"_c_{k}": c for k, c in counts.items()}}
    tied = df.withColumns(named | {"_tie": F.monotonically_increasing_id()})
    line = [*by, *order, "_tie"]
    ranged = tied.repartitionByRange(*line).sortWithinPartitions(*line).withColumn("_range", F.spark_partition_id())
    fields = [StructField("_pflat", BooleanType()), *(StructField(c, LongType()) for c in ("_padd", "_plow", *(f"_p_{k}" for k in counts), "_place"))]
    added = [f.name for f in fields]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, at, base = MovesInRange(by, totals), 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            if batch.num_rows:
                flat_, *whole = moves(batch)
                whole.append(np.arange(base + at, base + at + batch.num_rows))
                at += batch.num_rows
                yield pa.record_batch([*batch.columns, pa.array(flat_), *(pa.array(w, pa.int64()) for w in whole)], [*batch.schema.names, *added])

    rows = staged(ranged.mapInArrow(scan, StructType([*ranged.schema.fields, *fields])), label)
    # the move of a whole key in a range: what came before its last row, and that row
    total = {
        "flat": F.col("_pflat") | F.col("_flat"), "add": F.when(F.col("_flat"), 0).otherwise(F.col("_padd") + F.col("_add")),
        "low": F.when(F.col("_flat"), F.col("_low")).otherwise(F.greatest(F.col("_plow") + F.col("_add"), "_low")), **{k: F.col(f"_p_{k}") + F.col(f"_c_{k}") for k in counts},
    }
    tails = rows.groupBy(*by, "_range").agg(*[F.max_by(c, "_place").alias(k) for k, c in total.items()])
    several = tails.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by))).where(F.col("_n") > 1).drop("_n")

    def carry(key: tuple, ranges: pa.Table) -> pa.Table:
        value, counted, got = 0, [0] * len(totals), []
        for r in ranges.sort_by("_range").to_pylist():
            got.append((r["_range"], value, *counted))
            value = r["low"] if r["flat"] else max(value + r["add"], r["low"])
            counted = [c + r[k] for c, k in zip(counted, totals)]
        columns = list(zip(*got[1:]))
        kept = [pa.array([k.as_py()] * len(got[1:]), f.type) for k, f in zip(key, [ranges.schema.field(c) for c in by])]
        return pa.table([*kept, pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])], [*by, "_range", "_x", *(f"_x_{k}" for k in totals)])

    shape = StructType([*(rows.schema[c] for c in by), rows.schema["_range"], *(StructField(c, LongType()) for c in ("_x", *(f"_x_{k}" for k in counts)))])
    carried = F.broadcast(several.groupBy(*by).applyInArrow(carry, shape))  # one row for each range but the first, at most
    same = rows["_range"] == carried["_range"]
    for c in by:
        same = same & rows[c].eqNullSafe(carried[c])
    joined = rows.join(carried, same, "left").select(*[rows[c] for c in rows.columns], "_x", *(f"_x_{k}" for k in counts))
    start = F.coalesce("_x", F.lit(0))
    value = F.when(F.col("_pflat"), F.col("_plow")).otherwise(F.greatest(start + F.col("_padd"), "_plow"))
    return joined.select(*df.columns, "_place", value.alias(out), *[(F.coalesce(f"_x_{k}", F.lit(0)) + F.col(f"_p_{k}")).alias(k) for k in counts])
