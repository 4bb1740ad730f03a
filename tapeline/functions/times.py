"""Time text to Beijing wall-clock time.

Results are ``timestamp_ntz`` in Beijing time, so nothing here depends on the session time zone.
Python's ISO rules are kept by a shape test in front of every cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeline.functions.numbers import _col

ISO_SHAPE = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)?)?$"
)
OFFSET = r"(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)$"
EPOCH_MS_FROM = 10_000_000_000


def bind(expr: Column, fn) -> Column:
    """Evaluate ``expr`` once and hand it to ``fn``.

    Filters pushed through projections copy column definitions; without this a time read from a computed text
    would grow with every reference to that text.
    """
    return F.get(F.transform(F.array(expr), fn), F.lit(0))


def ntz(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def ntz_text(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a wall-clock time."""
    return F.substring(_col(c).cast("string"), 1, 19)


def iso_text(c: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss+08:00`` of a Beijing wall-clock time."""
    return F.concat(F.replace(ntz_text(c), F.lit(" "), F.lit("T")), F.lit("+08:00"))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Exact seconds between two wall-clock times, as double."""
    gap = (_col(later) - _col(earlier)).cast("interval second")
    return gap.cast("decimal(20,6)").cast("double")


def add_minutes(c: Column | str, minutes: Column | int) -> Column:
    m = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return _col(c) + F.make_dt_interval(F.lit(0), F.lit(0), m.cast("int"), F.lit(0).cast("decimal(18,6)"))


def _tail(text: Column) -> Column:
    """Zone designator of ISO text, or the empty string. Pure dates have none."""
    return F.when(F.length(text) > 10, F.regexp_extract(text, OFFSET, 0)).otherwise(F.lit(""))


def _offset_minutes(tail: Column) -> Column:
    hours = F.substring(tail, 2, 2).try_cast("int")
    mins = F.substring(F.regexp_replace(tail, ":", ""), 4, 2).try_cast("int")
    size = hours * 60 + mins
    return F.when(tail == "Z", F.lit(0)).when(tail.startswith("-"), -size).otherwise(size)


def iso_to_beijing(c: Column | str, naive_zone: str = "beijing") -> Column:
    """ISO text to Beijing time. Text without a zone is Beijing time or, with ``naive_zone='utc'``, UTC."""

    def read(text: Column) -> Column:
        tail = _tail(text)
        wall = ntz(F.when(F.length(text) <= 10, text).otherwise(F.replace(F.regexp_replace(text, OFFSET, ""), F.lit(","), F.lit("."))))
        naive_shift = F.lit(0 if naive_zone == "beijing" else 480)
        shift = F.when(tail == "", naive_shift).otherwise(F.lit(480) - _offset_minutes(tail))
        return F.when(text.rlike(ISO_SHAPE), add_minutes(wall, shift))

    return bind(F.trim(_col(c).cast("string")), read)


def epoch_to_beijing(c: Column | str) -> Column:
    """Seconds, or milliseconds above 10^10, since 1970 UTC."""
    v = _col(c).cast("double")

    def read(x: Column) -> Column:
        secs = F.when(x > EPOCH_MS_FROM, x / 1000).otherwise(x)
        day = F.floor(secs / 86400).cast("int")
        base = F.lit("1970-01-01 08:00:00").cast("timestamp_ntz")
        return base + F.make_dt_interval(day, F.lit(0), F.lit(0), (secs - day * 86400).cast("decimal(18,6)"))

    return bind(v, read)


# Non-padded variants that Python's strptime accepts; (shape, seconds suffix, note).
_LOOSE = (
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "", "%Y-%m-%d %H:%M:%S"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$", ":00", "%Y-%m-%d %H:%M"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", " 00:00:00", "%Y-%m-%d"),
)


def _loose(text: Column) -> tuple[Column, Column]:
    stamp, note = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("string")
    for shape, suffix, fmt in reversed(_LOOSE):
        parsed = F.when(text.rlike(shape), ntz(F.concat(text, F.lit(suffix))))
        stamp = F.coalesce(parsed, stamp)
        note = F.when(parsed.isNotNull(), F.lit(f"parsed_{fmt}_as_beijing")).otherwise(note)
    return stamp, note


def publish_time(c: Column | str, source: Column | str, enricher_notes: bool = False) -> Column:
    """Struct ``(ts, note)`` of a publish time in Beijing time, by source.

    A trailing ``Z`` is real UTC for ``cls`` and for ``cninfo`` at 16:00:00, and local time otherwise.
    The enrichment flavour spells two notes differently.
    """

    def read(x: Column) -> Column:
        raw, src = x["raw"], x["src"]
        text = F.trim(raw)
        bare = F.substring(text, 1, F.length(text) - 1)
        is_z = text.endswith("Z") & bare.rlike(ISO_SHAPE)
        is_utc = (src == "cls") | ((src == "cninfo") & bare.rlike(r"[T ]16:00:00$"))
        dashed = F.replace(text, F.lit("/"), F.lit("-"))
        chosen = F.when(is_z & is_utc, text).when(is_z, bare).otherwise(dashed)
        loose_ts, loose_note = _loose(dashed)
        label = F.when(src == "", F.lit("unknown")).otherwise(src) if enricher_notes else src
        if enricher_notes:
            utc_note = F.when(src == "cls", F.lit("cls_z_as_utc")).otherwise(F.lit("cninfo_midnight_z_as_utc"))
        else:
            utc_note = F.concat(src, F.lit("_z_as_utc"))
        z_note = F.when(is_utc, utc_note).otherwise(F.concat(label, F.lit("_z_as_beijing_local")))
        iso_note = F.when(_tail(dashed) == "", F.lit("naive_as_beijing")).otherwise(F.lit("timezone_converted_to_beijing"))
        note = (
            F.when(raw.isNull() | (raw == ""), F.lit("missing_publish_time"))
            .when((text == "") & F.lit(enricher_notes), F.lit("empty_publish_time"))
            .when(chosen.rlike(ISO_SHAPE), F.when(is_z, z_note).otherwise(iso_note))
            .otherwise(F.coalesce(loose_note, F.lit("unparsed_publish_time")))
        )
        return F.struct(F.coalesce(iso_to_beijing(chosen), loose_ts).alias("ts"), note.alias("note"))

    src = F.lower(F.coalesce(_col(source), F.lit("")))
    return bind(F.struct(_col(c).cast("string").alias("raw"), src.alias("src")), read)


def crawl_time(c: Column | str, now: Column | None = None, enricher_notes: bool = False) -> Column:
    """Struct ``(ts, note)`` of a collection time; ``Z`` is always UTC; missing or bad text takes ``now``."""

    def read(text: Column) -> Column:
        ts = iso_to_beijing(text)
        note = F.when(_tail(text) == "", F.lit("naive_as_beijing")).otherwise(F.lit("timezone_converted_to_beijing"))
        if enricher_notes:
            loose_ts, loose_note = _loose(text)
            note = F.when(text.rlike(ISO_SHAPE), note).otherwise(loose_note)
            ts = F.coalesce(ts, loose_ts)
        return F.struct(ts.alias("ts"), note.alias("note"))

    def default(x: Column) -> Column:
        fallback = now if now is not None else F.lit(None).cast("timestamp_ntz")
        note = F.when(x["ts"].isNull(), F.lit("generated_now")).otherwise(x["note"])
        return F.struct(F.coalesce(x["ts"], fallback).alias("ts"), note.alias("note"))

    text = F.replace(F.trim(_col(c).cast("string")), F.lit("/"), F.lit("-"))
    return bind(bind(text, read), default)


def latency_minutes(collected: Column | str, published: Column | str) -> Column:
    return seconds_between(collected, published) / F.lit(60.0)


def latency_level(minutes: Column | str) -> Column:
    v = _col(minutes)
    return (
        F.when(v.isNull(), F.lit("unknown"))
        .when(v < -1, F.lit("clock_skew"))
        .when(v <= 10, F.lit("fast"))
        .when(v <= 60, F.lit("normal"))
        .when(v <= 180, F.lit("slow"))
        .otherwise(F.lit("stale"))
    )


def many_formats(c: Column | str) -> Column:
    """Source time text to ``yyyy-MM-ddTHH:mm:ssZ``: dash, slash or 年月日 forms, then ISO text as is, then epoch.

    Anything else comes back unchanged.
    """

    def read(raw: Column) -> Column:
        text = F.trim(raw)
        one_style = r"^(\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{4}年\d{1,2}月\d{1,2}日)( |$)"
        plain = F.regexp_replace(F.regexp_replace(text, "[/年月]", "-"), "日", "")
        stamp, _ = _loose(plain)
        z = lambda t: F.concat(F.replace(ntz_text(t), F.lit(" "), F.lit("T")), F.lit("Z"))
        epoch = F.when(text.rlike(r"^[+-]?\d+$"), add_minutes(epoch_to_beijing(text), -480))
        return F.coalesce(z(F.when(text.rlike(one_style), stamp)), F.when(raw.contains("T"), raw), z(epoch), F.nullif(raw, F.lit("")))

    return bind(_col(c).cast("string"), read)


def statistics_time(c: Column | str) -> Column:
    """Time as the keyword statistics read it: one trailing Z is dropped, offsets are ignored, naive kept."""
    raw = _col(c).cast("string")
    text = F.regexp_replace(raw, "Z$", "")
    iso = F.when(text.rlike(ISO_SHAPE), ntz(F.regexp_replace(text, r"(?<=.{11})[+-]\d{2}:?\d{2}(:?\d{2})?$", "")))
    return F.coalesce(iso, F.when(raw.rlike(_LOOSE[0][0]), ntz(raw)))


def compact_to_date(c: Column | str) -> Column:
    """``YYYYMMDD`` or ``YYYY-MM-DD`` to a date."""
    text = F.trim(_col(c).cast("string"))
    dashed = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.when(dashed.rlike(r"^\d{4}-\d{2}-\d{2}$"), dashed.try_cast("date"))


def date_to_compact(c: Column | str) -> Column:
    return F.replace(_col(c).cast("string"), F.lit("-"), F.lit(""))


def minutes_of_day(c: Column | str) -> Column:
    text = ntz_text(c)
    return F.substring(text, 12, 2).cast("int") * 60 + F.substring(text, 15, 2).cast("int")


# Inclusive minute-of-day windows in which a snapshot mode is valid.
MODE_WINDOWS = {"morning": (9 * 60 + 14, 9 * 60 + 46), "midday": (9 * 60 + 47, 14 * 60 + 28), "overnight": (14 * 60 + 29, 15 * 60 + 2)}


def mode_window_valid(mode: Column | str, captured: Column | str) -> Column:
    m, minute = _col(mode), minutes_of_day(captured)
    out = F.lit(True)
    for name, (low, high) in MODE_WINDOWS.items():
        out = F.when(m == name, minute.between(low, high)).otherwise(out)
    return out


def mode_from_clock(captured: Column | str) -> Column:
    hour = F.floor(minutes_of_day(captured) / 60)
    return F.when(hour < 10, F.lit("morning")).when(hour < 14, F.lit("midday")).otherwise(F.lit("overnight"))


def collection_interval(source: Column | str, base: Column | str, now: Column | str, is_trade_day: Column | str) -> Column:
    """Expected seconds between collections for a source at a given clock time."""
    src, b, minute, day = _col(source), _col(base), minutes_of_day(now), F.coalesce(_col(is_trade_day), F.lit(False))
    in_market = day & minute.between(8 * 60 + 45, 15 * 60 + 30)
    def slow_floor(seconds: int) -> Column:
        return F.when(in_market, b).otherwise(F.greatest(b, F.lit(seconds)))

    return (
        F.when(src == "cls", slow_floor(15 * 60))
        .when(src == "eastmoney_global", slow_floor(20 * 60))
        .when(src == "cninfo", F.when(day & minute.between(15 * 60, 22 * 60), F.least(b, F.lit(15 * 60))).otherwise(slow_floor(60 * 60)))
        .when(src == "ndrc", F.when(day, b).otherwise(F.greatest(b, F.lit(2 * 60 * 60))))
        .otherwise(b)
    )


def item_date(*cols: Column | str) -> Column:
    """First field whose leading ten characters form a date, else ``unknown-date``."""
    parts = []
    for c in cols:
        head = F.substring(_col(c).cast("string"), 1, 10)
        parts.append(F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date").cast("string")))
    return F.coalesce(*parts, F.lit("unknown-date"))


def item_collected_at(*cols: Column | str) -> Column:
    """First field that parses as a time; text without a zone is Beijing time."""
    return F.coalesce(*[iso_to_beijing(c) for c in cols])
