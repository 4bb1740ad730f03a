"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its shuffled documents, served again from the front when it runs out, at most ``epochs``
times. An entry finishes at the virtual time (words its queue has served with it) / (the source's target), so all
queues reach their targets at time one. One global sort by finish time, cut at the total budget, is the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import WORD, pick, prefix_sums

EPOCHS = 3
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Target of each source from (source, source_size): shares by weight of the total, none above ``epochs`` times its size.

    Weights go round by the sources' order, null last. Sorted by cap per weight, a source is capped exactly if its cap is
    below the share that its weight has of what the capped ones before it leave.
    """
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = prefix_sums(sizes, [F.col("source")], {"rank": F.lit(1)}, "mix-ranks").withColumn("weight", turn.cast("bigint"))
    ranked = ranked.withColumn("cap", epochs * F.col("source_size"))
    ranked = prefix_sums(ranked, [F.col("cap") / F.col("weight"), F.col("rank")], {"cap_before": F.col("cap"), "weight_before": F.col("weight")}, "mix-caps")
    total, weight_sum = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(total) - F.col("cap_before")) / (F.lit(weight_sum) - F.col("weight_before"))
    ranked = ranked.withColumn("level", level)
    # the first source that is not capped sets the level of all that follow
    free = ranked.where(F.col("cap") / F.col("weight") >= F.col("level"))
    share = free.agg(F.min_by("level", F.struct(F.col("cap") / F.col("weight"), F.col("rank")))).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(share or 0.0) * F.col("weight"))
    return ranked.select("source", "rank", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = 7, keep: tuple[str, ...] = ()) -> DataFrame:
    """How many words the mix takes of each row of ``docs`` (doc_id, text, source): size, source_size, target, taken.

    Sizes are counts of words. Null and empty texts have size 0 and are not taken; a null source is a source of its own;
    equal rows are queued each for itself; an empty table gives an empty mix; other columns are ignored but for ``keep``
    (not text), which are passed on. The shuffle is a hash of doc_id and seed, so runs agree.
    """
    extra = [c for c in keep if c not in ("doc_id", "source", "text")]
    rows = pick(docs, "doc_id", "source", "text", *extra).select("doc_id", "source", *extra, word_count(F.col("text")).alias("size"))
    shuffled = F.xxhash64(F.lit(seed), "doc_id")
    rows = prefix_sums(rows, [F.col("source"), shuffled, F.col("doc_id"), F.col("size")], {"row": F.lit(1), "served": F.col("size")}, "mix-queues")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("served").alias("queue_at"))
    targets = source_targets(sizes, weights, epochs)
    by = rows["source"].eqNullSafe(targets["source"])
    rows = rows.join(targets, by).drop(targets["source"])
    at = sizes.select(F.col("source").alias("_s"), "queue_at")
    rows = rows.join(at, rows["source"].eqNullSafe(at["_s"])).drop("_s")
    turn = F.explode(F.when(F.col("size") > 0, F.sequence(F.lit(0), F.lit(epochs - 1))).otherwise(F.array(F.lit(0)))).alias("epoch")
    entries = rows.select("*", turn)
    served = F.col("epoch") * F.col("source_size") + F.col("served") - F.col("queue_at") + F.col("size")
    finish = F.when(F.col("size") > 0, served / F.col("target"))
    entries = prefix_sums(entries, [finish, F.col("rank"), F.col("epoch"), F.col("row")], {"before": F.col("size")}, "mix-entries")
    budget = sizes.agg(F.sum("source_size")).first()[0]
    took = F.when(F.col("before") + F.col("size") <= F.lit(budget), F.col("size")).otherwise(0)
    first = [F.first(c).alias(c) for c in dict.fromkeys(("doc_id", *keep, "size", "source_size", "target"))]
    return entries.groupBy("row").agg(*first, F.sum(took).alias("taken")).drop("row")


def take_mix(docs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it. Equal rows are taken as often as all of them are.

    Null and empty texts have no words and are not taken; rows with a null doc_id or source are taken like others; texts of any length
    count whole; an empty table gives an empty one; other columns are left out.
    """
    rows = pick(docs, *columns).withColumn("_row", F.xxhash64(*columns))
    mixed = mix(rows, keep=("_row",)).where(F.col("taken") > 0)
    times = mixed.groupBy("doc_id", "_row").agg(F.sum(F.expr("taken div size")).alias("_times"))
    same = rows["doc_id"].eqNullSafe(times["doc_id"]) & (rows["_row"] == times["_row"])
    one = rows.join(times, same).drop(times["doc_id"]).drop(times["_row"]).dropDuplicates(["doc_id", "_row"])
    return one.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select(*columns)
