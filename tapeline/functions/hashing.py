"""Ids, dedup keys and content hashes. All are whole-value SHA-256 digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions.numbers import _col


def _or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def digest(*cols: Column | str, length: int = 64) -> Column:
    joined = F.concat_ws("|", *[_or_empty(c) for c in cols])
    return F.substring(F.sha2(joined, 256), 1, length)


def item_id(source="source", stock_code="stock_code", title="title", publish_time="publish_time", url="url") -> Column:
    """News item id: 24 hex digits over the five identifying fields."""
    return digest(source, stock_code, title, publish_time, url, length=24)


def snapshot_id(mode: Column | str, captured_at: Column | str) -> Column:
    """``20260617T145000_overnight_<10 hex>``; ``captured_at`` is ISO text to the second with its offset."""
    iso, m = _col(captured_at), _col(mode)
    stamp = F.regexp_replace(F.substring(iso, 1, 19), "[-:]", "")
    return F.concat_ws("_", stamp, m, F.substring(F.sha2(F.concat_ws("|", m, iso), 256), 1, 10))


def historical_snapshot_id(source_name: Column | str, market_date: Column | str, n_rows: Column | str) -> Column:
    """``20260617_historical_<16 hex>`` over source, date (YYYYMMDD) and row count."""
    return F.concat_ws("_", _col(market_date), F.lit("historical"), digest(source_name, market_date, n_rows, length=16))


def dedup_key(source="source", url="url", stock_code="stock_code", title="title", publish_time="publish_time") -> Column:
    """Key of one stored item: announcements by code, title and time; others by URL, else title and time."""
    triple = F.concat_ws("|", _or_empty(stock_code), _or_empty(title), _or_empty(publish_time))
    pair = F.concat_ws("|", _or_empty(title), _or_empty(publish_time))
    return F.when(_col(source) == "cninfo", triple).otherwise(
        F.coalesce(F.nullif(_col(url).cast("string"), F.lit("")), pair)
    )


def dedup_hash(source="source", url="url", stock_code="stock_code", title="title", publish_time="publish_time") -> Column:
    """Source-wide seen-before hash. URL hashes carry no source, so equal URLs collide across sources."""
    return F.sha2(dedup_key(source, url, stock_code, title, publish_time), 256)


def content_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Hash over named columns in sorted order; nulls are kept distinct from the empty string."""
    names = sorted(columns or df.columns)
    return F.sha2(F.to_json(F.struct(*[F.col(n) for n in names]), {"ignoreNullFields": "false"}), 256)


def dataset_version(df: DataFrame, key: str, by: list[str] | None = None, length: int = 20) -> DataFrame:
    """Order-free version of a dataset: counts and two independent sums over row hashes.

    Sums combine map-side, so no member list is ever gathered in one task.
    """
    h1 = F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 8), 16, 10).cast("decimal(38,0)")
    h2 = F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 9, 8), 16, 10).cast("decimal(38,0)")
    out = df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_members"), F.sum(h1).alias("_s1"), F.sum(h2).alias("_s2")
    )
    s1 = F.coalesce(F.col("_s1"), F.lit(0)).cast("string")
    s2 = F.coalesce(F.col("_s2"), F.lit(0)).cast("string")
    version = F.substring(F.sha2(F.concat_ws("|", F.col("n_members").cast("string"), s1, s2), 256), 1, length)
    return out.withColumn("dataset_version", version).drop("_s1", "_s2")
