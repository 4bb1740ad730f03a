"""All pairs of rows that share a key, in bounded pieces.

Rows are dealt and sorted by key and streamed, so small buckets cost no task or call of their own. A bucket of more than
``CELL`` rows is not held: its rows are set aside in blocks, and the second pass deals each pair of blocks to a group of its
own. So every pair is seen, each once for each key that it shares, and no task's memory or time grows with a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tapeline.session import staged

CELL = 2048
#: Pairs that are handed over at once.
PAIRS = 100_000
#: Called with rows of some buckets and the places of pairs among them; gives rows of the result.
Judge = Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table]


def _pairs(key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i < j, of equal neighbours in sorted ``key``, some at a time."""
    i = np.arange(len(key) - 1)
    left, right, held, d = [], [], 0, 1
    while len(i := i[i + d < len(key)]) and len(i := i[key[i] == key[i + d]]):
        left.append(i)
        right.append(i + d)
        held += len(i)
        d += 1
        if held >= PAIRS:
            yield np.concatenate(left), np.concatenate(right)
            left, right, held = [], [], 0
    if held:
        yield np.concatenate(left), np.concatenate(right)


def _judged(rows: pa.Table, judge: Judge) -> Iterator[pa.Table]:
    for i, j in _pairs(rows.column("key").to_numpy()):
        for lo in range(0, len(i), PAIRS):
            if (out := judge(rows, i[lo : lo + PAIRS], j[lo : lo + PAIRS])).num_rows:
                yield out


def in_buckets(rows: DataFrame, judge: Judge, schema: str, label: str, cell: int = CELL) -> DataFrame:
    """What ``judge`` makes (rows of ``schema``) of all pairs of ``rows`` with equal ``key`` (bigint)."""
    names = rows.columns
    spark = rows.sparkSession
    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    aside = ", ".join(f"`_{n}` {t}" for n, t in rows.dtypes)
    made = to_arrow_schema(spark.createDataFrame([], schema).schema)
    whole = to_arrow_schema(spark.createDataFrame([], f"{schema}, {aside}, _block int").schema)

    def widen(part: pa.Table, renamed: dict[str, str]) -> Iterator[pa.RecordBatch]:
        n = part.num_rows
        have = {renamed.get(c, c): part.column(c) for c in part.column_names}
        yield from pa.table([have[f.name].cast(f.type) if f.name in have else pa.nulls(n, f.type) for f in whole], schema=whole).to_batches(max_chunksize=20_000)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        under = {n: f"_{n}" for n in names}
        held, hot, laid = None, None, 0  # rows of the last key; the key being set aside and how many of its rows are

        def lay(part: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal laid
            block = pa.array((np.arange(part.num_rows) + laid) // cell, pa.int32())
            laid += part.num_rows
            yield from widen(part.append_column("_block", block), under)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            key = rows.column("key").to_numpy()
            if not len(key):
                continue
            if hot is not None:
                n = int(np.searchsorted(key, hot, "right"))
                yield from lay(rows.slice(0, n))
                rows, key, held = rows.slice(n), key[n:], None
                if not len(key):
                    continue
                hot = None
            start = int(np.searchsorted(key, key[-1], "left"))
            # a bucket over the cell size can be inside of a batch as well
            yield from closed(rows.slice(0, start), key[:start])
            held = rows.slice(start).combine_chunks()
            if held.num_rows > cell:
                hot, laid = key[-1], 0
                yield from lay(held)
                held = None
        if held is not None:
            yield from closed(held, held.column("key").to_numpy())

    def closed(rows: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole buckets; rows that are alone with their key are left out."""
        if not len(key):
            return
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.concatenate((first, [len(key)])))
        each = np.repeat(size, size)
        if len(some := np.flatnonzero((each > 1) & (each <= cell))):
            for out in _judged(rows.take(some).combine_chunks(), judge):
                yield from widen(out, {})
        for f, s in zip(first[size > cell].tolist(), size[size > cell].tolist()):
            block = pa.array(np.arange(s) // cell, pa.int32())
            yield from widen(rows.slice(f, s).append_column("_block", block), {n: f"_{n}" for n in names})

    first = staged(rows.repartition("key").sortWithinPartitions("key").mapInArrow(stream, f"{schema}, {aside}, _block int"), label, "zstd")
    out = [f.name for f in made]
    done = first.where("_block IS NULL").select(*out)
    rest = first.where("_block IS NOT NULL").select(*[F.col(f"_{n}").alias(n) for n in names], "_block")
    if rest.isEmpty():
        return done

    blocks = rest.groupBy("key").agg((F.max("_block") + 1).alias("_blocks"))
    cells = rest.join(blocks, "key").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cells = cells.withColumn("_lo", F.least("_block", "_other")).withColumn("_hi", F.greatest("_block", "_other"))

    def grid(group: pa.Table) -> pa.Table:
        block = group.column("_block").to_numpy()
        lo, hi = group.column("_lo")[0].as_py(), group.column("_hi")[0].as_py()
        order = np.argsort(block, kind="stable")
        group, n = group.take(order).select(names).combine_chunks(), int((block == lo).sum())
        parts = []
        for i in range(n):  # one row against the other block, or against what follows in its own
            j = np.arange(i + 1, n) if lo == hi else np.arange(n, group.num_rows)
            parts.append((np.full(len(j), i), j))
        got = []
        i, j = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, int),) * 2
        for at in range(0, len(i), PAIRS):
            got.append(judge(group, i[at : at + PAIRS], j[at : at + PAIRS]).cast(made))
        return pa.concat_tables(got) if got else made.empty_table()

    return done.unionByName(cells.groupBy("key", "_lo", "_hi").applyInArrow(grid, schema))
