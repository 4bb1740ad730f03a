"""Text rules: repair, keyword hits, regular expressions, list fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeline.functions.numbers import _col
from tapeline.functions.times import bind

# Patterns of the social extractor.
STOCK_CODE = r"(?<!\d)([036]\d{5}|[123]\d{5}|688\d{3}|8\d{5}|9\d{5})(?!\d)"
MARKET_RELEVANCE = (
    r"(?iu)股市|股票|A股|证券|财经|炒股|板块|主线|涨停|高开|低开|短线|T\+1|"
    r"PCB|半导体|芯片|算力|机器人|有色|稀土|煤炭|化工|涨价|订单|政策|关税|汇率|利率"
)


def repair_mojibake(c: Column | str) -> Column:
    """Undo UTF-8 read as Latin-1 where the marks of it show; unchanged where that fails."""

    def fix(v: Column) -> Column:
        raw = F.encode(v, "ISO-8859-1")
        fixable = v.rlike("[äãÂ]") & v.rlike(r"^[\u0000-ÿ]*$") & F.is_valid_utf8(raw.cast("string"))
        return F.coalesce(F.when(fixable, F.nullif(F.decode(raw, "UTF-8"), F.lit(""))), v)

    return bind(_col(c), fix)


def combined_text(*cols: Column | str) -> Column:
    """Non-empty fields joined by one blank."""
    return F.concat_ws(" ", *[F.nullif(_col(c).cast("string"), F.lit("")) for c in cols])


def words(keywords: Sequence[str]) -> Column:
    return F.array(*[F.lit(k) for k in keywords]) if keywords else F.array().cast("array<string>")


def keyword_hits(text: Column, keywords: Sequence[str], ignore_case: bool = False) -> Column:
    """Keywords contained in the text, in dictionary order."""
    if not keywords:
        return F.array().cast("array<string>")

    def cells(t: Column) -> Column:
        return F.array_compact(F.array(*[F.when(t.contains(k.lower() if ignore_case else k), F.lit(k)) for k in keywords]))

    return bind(F.lower(text), cells) if ignore_case else cells(text)


def any_keyword(text: Column, keywords: Sequence[str], ignore_case: bool = False) -> Column:
    t = F.lower(text) if ignore_case else text
    out = F.lit(False)
    for k in keywords:
        out = out | t.contains(k.lower() if ignore_case else k)
    return F.coalesce(out, F.lit(False))


def occurrences(text: Column, keyword: Column | str) -> Column:
    """Non-overlapping occurrences of a keyword."""
    k = F.lit(keyword) if isinstance(keyword, str) else keyword
    return ((F.length(text) - F.length(F.replace(text, k, F.lit("")))) / F.length(k)).cast("int")


def stock_codes(text: Column | str) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(_col(text), F.lit(STOCK_CODE), F.lit(1))))


def market_relevant(text: Column | str) -> Column:
    return F.coalesce(_col(text), F.lit("")).rlike(MARKET_RELEVANCE)


def one_line(text: Column | str, length: int | None = None) -> Column:
    v = F.trim(F.regexp_replace(_col(text), r"\s+", " "))
    return v if length is None else F.substring(v, 1, length)


def split_list(raw: Column | str, separators: str = ",") -> Column:
    """A JSON array or a delimited string to trimmed non-empty entries."""
    v = F.trim(_col(raw))
    as_array = F.from_json(v, "array<string>")
    as_text = F.split(v, f"[{separators}]")
    chosen = F.when(v.startswith("["), as_array).otherwise(as_text)
    trimmed = F.transform(chosen, lambda x: F.trim(x))
    return F.coalesce(F.filter(trimmed, lambda x: x != ""), F.array().cast("array<string>"))


def json_path(doc: Column | str, path: str, default: str | None = None) -> Column:
    """Nested lookup by dotted path; digits index arrays."""
    steps = "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in path.split("."))
    return F.coalesce(F.get_json_object(_col(doc), "$" + steps), F.lit(default))


def absolute_url(url: Column | str, base: str) -> Column:
    v = F.coalesce(_col(url), F.lit(""))
    return (
        F.when((v == "") | v.startswith("http"), v)
        .when(v.startswith("/"), F.concat(F.lit(base), v))
        .otherwise(F.concat(F.lit(base + "/"), v))
    )


def ordered_union(*arrays: Column) -> Column:
    """Order-preserving union of string arrays without empty entries."""
    filled = [F.coalesce(a, F.array().cast("array<string>")) for a in arrays]
    return F.array_distinct(F.filter(F.concat(*filled), lambda u: u.isNotNull() & (u != "")))
