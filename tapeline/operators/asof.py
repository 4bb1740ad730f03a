"""Point-in-time joins: as-of panels, next-session lookups, visible messages, name mentions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tapeline.functions.codes import normalized_name
from tapeline.functions.text import any_keyword
from tapeline.session import staged

# Clock of the information cutoff per decision mode, and the message lookback.
CUTOFF_CLOCK = {"morning": "09:25:00", "overnight": "15:00:00"}
LOOKBACK_DAYS = 4


def as_of_panel(rows: DataFrame, last_session_no: Column) -> DataFrame:
    """Each code's latest row repeated for every market session until its next own row (``as_of_no``).

    Rows carry ``session_no`` and ``next_session_no``; validity intervals replace a range join.
    """
    until = F.coalesce(F.col("next_session_no") - 1, last_session_no)
    return rows.withColumn("as_of_no", F.explode(F.sequence(F.col("session_no"), until)))


def decisions(sessions: DataFrame) -> DataFrame:
    """Two decisions per session: morning on the previous session's bars, overnight on its own.

    ``sessions`` holds (session, session_no) with consecutive numbers.
    """
    modes = F.explode(
        F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(c).alias("clock"), F.lit(int(m == "morning")).alias("back")) for m, c in CUTOFF_CLOCK.items()])
    )
    first = sessions.groupBy().agg(F.min("session_no"))
    d = sessions.select(F.col("session").alias("decision_date"), F.col("session_no").alias("decision_no"), modes.alias("m"))
    cutoff = F.concat_ws(" ", F.col("decision_date").cast("string"), F.col("m.clock")).cast("timestamp_ntz")
    lower = cutoff - F.make_dt_interval(F.lit(LOOKBACK_DAYS))
    return d.select(
        "decision_date", "decision_no", "m.mode", (F.col("decision_no") - F.col("m.back")).alias("as_of_no"),
        cutoff.alias("cutoff"), lower.alias("lower"),
    ).where(F.col("as_of_no") >= first.scalar())


def visible_messages(messages: DataFrame, decisions_: DataFrame, stamp: str = "stamp") -> DataFrame:
    """Messages inside each decision's closed interval, by equi-join on covered days and an exact bound test."""
    days = F.explode(F.sequence(F.col("lower").cast("date"), F.col("cutoff").cast("date")))
    wanted = decisions_.select("mode", "decision_no", "lower", "cutoff", days.alias("_day"))
    dated = messages.where(F.col(stamp).isNotNull()).withColumn("_day", F.col(stamp).cast("date"))
    inside = (F.col(stamp) >= F.col("lower")) & (F.col(stamp) <= F.col("cutoff"))
    return dated.join(wanted, "_day").where(inside).drop("_day", "lower")


#: Most characters of a name's beginning that texts are met by, where names are too many for an automaton.
BLOCK = 8
#: Names of one automaton, and automata a text is passed through. An automaton takes some hundred bytes a name in each worker.
AUTOMATON_NAMES, AUTOMATA = 200_000, 8
_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def _automaton(key: str, shared: Broadcast) -> ahocorasick.Automaton:
    """Finds all names at once; a worker builds it once and keeps the last ones."""
    if key not in _AUTOMATA:
        while len(_AUTOMATA) >= 2:
            del _AUTOMATA[next(iter(_AUTOMATA))]
        built = ahocorasick.Automaton()
        for name, codes in shared.value.items():
            built.add_word(name, (name, codes))
        built.make_automaton()
        _AUTOMATA[key] = built
    return _AUTOMATA[key]


def _mentions_of(items: DataFrame, names: dict[str, list]) -> DataFrame:
    """One pass over every text (column ``_text``) with an automaton of these names."""
    shared, key = items.sparkSession.sparkContext.broadcast(names), uuid.uuid4().hex
    at = items.columns.index("_text")
    pair = pa.list_(pa.struct([("code", pa.string()), ("norm_name", pa.string())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, shared)
        for batch in batches:
            found = []
            for text in batch.column(at).to_pylist():
                there = dict(v for _, v in automaton.iter(text or "")) if len(automaton) else {}  # an empty one cannot be searched
                found.append([{"code": code, "norm_name": name} for name, codes in there.items() for code in codes])
            yield pa.record_batch([*batch.columns[:at], *batch.columns[at + 1 :], pa.array(found, pair)], fields)

    kept = [f for f in items.schema.fields if f.name != "_text"]
    mention = ArrayType(StructType([StructField("code", StringType()), StructField("norm_name", StringType())]))
    fields = [*(f.name for f in kept), "_mentions"]
    # a row for each mention is made afterwards, from the columns that are asked for
    out = items.mapInArrow(find, StructType([*kept, StructField("_mentions", mention)]))
    return out.select(*[f.name for f in kept], F.explode("_mentions").alias("_m")).select(*[f.name for f in kept], "_m.code", "_m.norm_name")


def name_mentions(items: DataFrame, names: DataFrame, text: str = "title", min_length: int = 3) -> DataFrame:
    """Which names occur inside which texts: (item columns, code, norm_name), one row per pair.

    An Aho-Corasick automaton finds all names in one pass over a text; nothing is shuffled and no text is copied. Names beyond
    ``AUTOMATON_NAMES`` are dealt over several automata of about equal size, whatever names begin with, and each takes a pass. Names beyond all
    of these meet the texts in a join (``joined_mentions``). Names are counted first. Null texts mention nothing.
    """
    known = names.select(F.col("code").cast("string").alias("code"), normalized_name("name").alias("norm_name")).where(F.length("norm_name") >= min_length).distinct()
    texts = items.withColumn("_text", normalized_name(text))
    n = known.count()
    parts = max(1, -(-n // AUTOMATON_NAMES))
    if parts > AUTOMATA:
        return joined_mentions(texts, known)
    out = []
    for part in range(parts):
        of = known.where(F.pmod(F.xxhash64("norm_name", "code"), F.lit(parts)) == part)
        by_name: dict[str, list] = {}
        for code, name in of.orderBy("norm_name", "code").toLocalIterator():  # a checked number of names
            by_name.setdefault(name, []).append(code)
        if by_name or not out:
            out.append(_mentions_of(texts, by_name))
    return reduce(DataFrame.unionByName, out)


def joined_mentions(texts: DataFrame, known: DataFrame) -> DataFrame:
    """The same by a join, for any number of names: texts need ``_text``, ``known`` code and norm_name.

    The distinct runs of a text of as many characters as the shortest name has, at most ``BLOCK``, are joined with the beginnings of
    the names. Only the text's number goes with them; each text then meets its candidates once, and they are searched for as wholes.
    """
    block = min(BLOCK, known.agg(F.min(F.length("norm_name"))).first()[0] or BLOCK)
    known = known.withColumn("_block", F.substring("norm_name", 1, block))
    texts = staged(texts.withColumn("_no", F.monotonically_increasing_id()), "texts")
    chars, length = F.split("_text", ""), F.length("_text")
    starts = F.when(length >= block, F.sequence(F.lit(1), length - block + 1))
    runs = texts.select("_no", starts.alias("_at"), chars.alias("_chars"))
    runs = runs.select("_no", F.explode(F.array_distinct(F.transform("_at", lambda i: F.array_join(F.slice("_chars", i, F.lit(block)), "")))).alias("_block"))
    met = runs.join(known, "_block").select("_no", "code", "norm_name")
    return texts.join(met, "_no").where(F.contains("_text", "norm_name")).select(*[c for c in texts.columns if c not in ("_no", "_text")], "code", "norm_name")


def event_counters(messages: DataFrame, names: DataFrame, decisions_: DataFrame, positive, risk) -> tuple[DataFrame, DataFrame]:
    """Announcement counters per (decision, code) and news counters per (decision, code, norm_name).

    Mentions are matched once per message, before a message is spread over the decisions that see it.
    """
    keep = ["doc_id", "kind", "stock_code", "title", "stamp"]
    flags = {
        "_pos": any_keyword(F.coalesce("title", F.lit("")), positive).cast("int"),
        "_risk": any_keyword(F.coalesce("title", F.lit("")), risk).cast("int"),
    }
    ann = messages.where("kind = 'announcement'").select(*keep).withColumns(flags)
    ann = ann.withColumn("code", F.lpad(F.coalesce("stock_code", F.lit("")), 6, "0")).select("code", "stamp", "_pos", "_risk")
    # News flags are read from the normalized title, as the matching is.
    norm = normalized_name("title")
    nflags = {"_pos": any_keyword(norm, positive).cast("int"), "_risk": any_keyword(norm, risk).cast("int")}
    newsm = name_mentions(messages.where("kind = 'news'").select(*keep).withColumns(nflags), names)
    newsm = newsm.select("code", "norm_name", "stamp", "_pos", "_risk")

    def count(df: DataFrame, by: list[str], names_: tuple[str, str, str]) -> DataFrame:
        return visible_messages(df, decisions_).groupBy("mode", "decision_no", *by).agg(
            F.count(F.lit(1)).alias(names_[0]), F.sum("_pos").alias(names_[1]), F.sum("_risk").alias(names_[2])
        )

    return (
        count(ann, ["code"], ("ann_count", "positive_ann", "risk_ann")),
        count(newsm, ["code", "norm_name"], ("news_mentions", "positive_news", "risk_news")),
    )


def with_events(features: DataFrame, ann: DataFrame, news: DataFrame) -> DataFrame:
    """Features of every decision with zero-filled counters and their totals."""
    key = ["mode", "decision_no", "code"]
    df = features.withColumn("norm_name", normalized_name("name")).join(ann, key, "left").join(news, [*key, "norm_name"], "left")
    df = df.fillna(0, ["ann_count", "positive_ann", "risk_ann", "news_mentions", "positive_news", "risk_news"])
    return df.withColumns(
        {"risk_hits": F.col("risk_ann") + F.col("risk_news"), "positive_hits": F.col("positive_ann") + F.col("positive_news")}
    ).drop("norm_name")


def next_session_outcomes(picks: DataFrame, bars: DataFrame, last_session_no: Column, threshold: float = 0.5) -> DataFrame:
    """T+1 result of each pick: entry at the decision session, returns on the next market session."""
    w = Window.partitionBy("code").orderBy("session_no")
    prices = F.struct(
        "session_no", "session", F.nullif(F.col("open"), F.lit(0.0)).alias("open"), "high", "low", F.nullif(F.col("close"), F.lit(0.0)).alias("close")
    )
    # The next own bar counts only when it lies on the very next market session.
    own = bars.select(
        "code", F.col("session_no").alias("decision_no"), F.col("open").alias("_eo"), F.col("close").alias("_ec"), F.lead(prices).over(w).alias("_x")
    )
    adjacent = F.when(F.col("_x.session_no") == F.col("decision_no") + 1, F.col("_x"))
    own = own.withColumn("_x", adjacent)
    df = picks.join(own, ["code", "decision_no"], "left")
    df = df.withColumns({"_nd": F.col("_x.session"), **{f"_n_{c}": F.col(f"_x.{c}") for c in ("open", "high", "low", "close")}})
    entry = F.nullif(F.when(F.col("mode") == "morning", F.col("_eo")).otherwise(F.col("_ec")), F.lit(0.0))
    whole = entry.isNotNull()
    for c in ("open", "high", "low", "close"):
        whole = whole & F.col(f"_n_{c}").isNotNull()
    status = F.when(F.col("decision_no") >= last_session_no, "pending").when(whole, "complete").otherwise("missing")
    df = df.withColumn("status", status).withColumn("entry_price", F.when(F.col("status") == "complete", entry))
    raw = {c: (F.col(f"_n_{c}") / F.col("entry_price") - 1.0) * 100.0 for c in ("open", "high", "low", "close")}
    return df.select(
        *picks.columns, "status", "entry_price",
        F.when(F.col("status") == "complete", F.col("_nd")).alias("next_date"),
        *[F.round(e, 4).alias(f"next_{c}_return") for c, e in raw.items()],
        (raw["high"] >= threshold).alias("red_window"),
        (raw["open"] > 0).alias("positive_open"),
        (raw["close"] > 0).alias("positive_close"),
        (raw["high"] <= 0).alias("no_red"),
    )


def outcome_summary(records: DataFrame, by: list[str]) -> DataFrame:
    """Rates, means and medians of completed outcomes; a group holds at most one row per session."""
    pct = lambda c: (F.avg(F.col(c).cast("double")) * 100).alias(f"{c}_rate")
    return records.where("status = 'complete'").groupBy(*by).agg(
        F.count(F.lit(1)).alias("samples"),
        pct("red_window"), pct("positive_open"), pct("positive_close"), pct("no_red"),
        F.avg("next_open_return").alias("mean_open_return"),
        F.median("next_high_return").alias("median_high_return"),
        F.avg("next_high_return").alias("mean_high_return"),
        F.median("next_close_return").alias("median_close_return"),
        F.avg("next_close_return").alias("mean_close_return"),
        F.min("next_low_return").alias("worst_low_return"),
    )
