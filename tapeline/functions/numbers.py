"""Null, zero and number rules. Three parsers differ on purpose; see each docstring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal or exponent notation; keeps Java suffixes such as "1d" out.
NUMERIC = r"(?i)^\s*[+-]?(\d+(\.\d*)?([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|nan|inf|infinity)\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parsed(c: Column | str) -> Column:
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMERIC), F.trim(text).try_cast("double"))


def num_null(c: Column | str) -> Column:
    """Number or null; infinities and NaN are kept."""
    return _parsed(c)


def num_null_finite(c: Column | str) -> Column:
    """Number or null; infinities and NaN count as missing."""
    return finite(_parsed(c))


def num0(*cols: Column | str) -> Column:
    """First alternative that parses, else 0.0 (never null)."""
    return F.coalesce(*[_parsed(c) for c in cols], F.lit(0.0))


def finite(c: Column | str) -> Column:
    """NaN and infinities to null."""
    v = _col(c)
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def first_text(*cols: Column | str) -> Column:
    """First non-empty text, else the empty string."""
    return F.coalesce(*[F.nullif(_col(c).cast("string"), F.lit("")) for c in cols], F.lit(""))


def or_else(a: Column | str, b: Column | str) -> Column:
    """``a`` unless it is null or zero, then ``b``."""
    return F.coalesce(F.nullif(_col(a), F.lit(0.0)), _col(b))


def pct_change(current: Column | str, previous: Column | str) -> Column:
    """Percent change; null when either side is missing or the base is zero."""
    cur, prev = _col(current), _col(previous)
    return (cur / F.nullif(prev, F.lit(0.0)) - F.lit(1.0)) * F.lit(100.0)


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``, null when ``b`` is null or zero."""
    return _col(a) / F.nullif(_col(b), F.lit(0.0))


def in_range(c: Column | str, low: float, high: float) -> Column:
    """Inclusive range test where null counts as outside."""
    v = _col(c)
    return F.coalesce((v >= F.lit(low)) & (v <= F.lit(high)), F.lit(False))


def truthy(c: Column | str) -> Column:
    """Neither null nor zero."""
    v = _col(c)
    return F.coalesce(v != F.lit(0.0), F.lit(False))


def holds(cond: Column) -> Column:
    """Three-valued condition folded to true/false."""
    return F.coalesce(cond, F.lit(False))


def all_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a & b, [holds(c) for c in conds])


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high)))
