"""Helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.session import staged

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
#: What counts as white space between words; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of texts that go to a Python worker at once.
BATCH_ROWS = 2000


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``BATCH_ROWS`` rows: texts are long, and workers have little memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no other. Extra columns are left out, even where their names differ in case only."""
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    at = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    return flat.select(*[F.col(f"_c{at[n]}").alias(n) for n in names])


def prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, Column], label: str, modulus: int | None = None) -> DataFrame:
    """For each row and each of ``sums`` (name: expression of whole numbers), the sum over all rows before it in ``order``.

    With ``modulus`` (a power of two up to 2^32) sums are kept modulo it: every partial sum is cut to its low bits, so numbers
    below 2^32 cannot leave 64 bits however many rows there are (up to 2^31 in a range, and as many ranges).

    Two passes: rows are dealt by range and summed inside each range; the totals of the ranges, one row for each, give
    the offset of each range. Rows that tie in ``order`` follow in the order in which they are read. As their read
    position is part of the sort key, a run of equal rows of any length is cut between ranges, so no task holds a key.
    """
    keys = [f"_o{i}" for i in range(len(order))]
    df = df.withColumns(dict(zip(keys, order)) | {f"_v_{k}": c.cast("bigint") for k, c in sums.items()})
    df = df.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(k).asc_nulls_last() for k in keys] + [F.col("_tie")]
    rows = staged(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id()), label)
    low = (lambda c: c.bitwiseAND(F.lit(modulus - 1).cast("bigint"))) if modulus else (lambda c: c)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("_part").agg(*[low(F.sum(f"_v_{k}")).alias(f"_t_{k}") for k in sums]).select(
        "_part", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in sums]
    )
    inside = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"_l_{k}": F.coalesce(F.sum(f"_v_{k}").over(inside), F.lit(0)) for k in sums})
    out = rows.join(F.broadcast(bases), "_part")  # a row for each range: as many as there are shuffle partitions
    out = out.withColumns({k: low(low(F.col(f"_b_{k}")) + low(F.col(f"_l_{k}"))) for k in sums})
    return out.drop("_part", "_tie", *keys, *[f"_{x}_{k}" for k in sums for x in "vbl"])
