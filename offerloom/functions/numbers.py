"""Column functions on amounts, counts and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.functions.text import blank_to_null, fold_ascii

#: Time formats that are tried in this order after Spark's own.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "yyyyMMdd_HHmmss", "yyyyMMdd")
FREE_SHIPPING = "frete gratis|envio gratis|entrega gratis|free shipping"


def parse_money(c: Column, style: str = "auto_tail") -> Column:
    """An amount from text.

    auto: with both separators dots are thousands; a comma alone is the decimal point. auto_tail: also, dots alone are thousands
    unless one or two digits follow the last. br: dots are always thousands. search: the first ``R$ 1.234,56`` in the text.
    """
    s = c.cast("string")
    if style == "search":
        s = F.regexp_extract(s, "R\\$\\s*([0-9]{1,3}(?:\\.[0-9]{3})*(?:,[0-9]{1,2})?|[0-9]+(?:,[0-9]{1,2})?)", 1)
        return F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    s = F.regexp_replace(s, "[^0-9,.-]", "")
    comma, dot = F.contains(s, F.lit(",")), F.contains(s, F.lit("."))
    no_dots = F.replace(s, F.lit("."), F.lit(""))
    if style == "br":
        return F.replace(no_dots, F.lit(","), F.lit(".")).try_cast("double")
    if style == "auto":
        dots = s
    elif style == "auto_tail":
        dots = F.when(s.rlike("\\.[0-9]{1,2}$"), F.concat(F.replace(F.regexp_extract(s, "^(.*)\\.[0-9]{1,2}$", 1), F.lit("."), F.lit("")), F.lit("."), F.regexp_extract(s, "\\.([0-9]{1,2})$", 1))).otherwise(no_dots)
    else:
        raise ValueError(f"unknown style {style}")
    out = F.when(comma & dot, F.replace(no_dots, F.lit(","), F.lit("."))).when(comma, F.replace(s, F.lit(","), F.lit("."))).when(dot, dots).otherwise(s)
    return out.try_cast("double")


def to_price(c: Column, kind: str, style: str = "auto_tail") -> Column:
    """A price column of any type: numbers pass, text is parsed. ``kind`` is the column's type name."""
    return parse_money(c, style) if kind == "string" else to_double(c, kind)


def money_parts(whole: Column, cents: Column) -> Column:
    """An amount from the texts of its whole and cent parts."""
    a, b = (blank_to_null(F.regexp_replace(x.cast("string"), "[^0-9]", "")) for x in (whole, cents))
    return F.concat(a, F.lit("."), F.lpad(F.coalesce(b, F.lit("00")), 2, "0")).try_cast("double")


def to_double_safe(c: Column) -> Column:
    """Null for what is no finite number."""
    v = F.trim(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def to_double(c: Column, kind: str) -> Column:
    """N3 of a column whose type is known: numbers need no way over text (but floats, which would gain digits)."""
    if kind not in ("tinyint", "smallint", "int", "bigint", "double") and not kind.startswith("decimal"):
        return to_double_safe(c)
    v = c.cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def to_ts(c: Column, kind: str) -> Column:
    """N4 of a column whose type is known: times need no way over text."""
    return c.cast("timestamp_ntz") if kind in ("date", "timestamp", "timestamp_ntz") else parse_ts(c)


def parse_ts(c: Column) -> Column:
    """A time without zone (UTC) from text; null if no format fits."""
    s = c.cast("string")
    return F.coalesce(s.try_cast("timestamp_ntz"), *[F.try_to_timestamp(s, F.lit(f)).cast("timestamp_ntz") for f in TIME_FORMATS])


def ts_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def parse_count(c: Column) -> Column:
    """The first whole number, separators between its digits removed."""
    found = F.regexp_extract(c, "([0-9][0-9.,]*)", 1)
    return F.regexp_replace(found, "[^0-9]", "").try_cast("long")


def parse_rating(c: Column) -> Column:
    """The first number with an optional decimal part (``4,7 de 5``)."""
    return F.replace(F.regexp_extract(c, "([0-9]+(?:[.,][0-9]+)?)", 1), F.lit(","), F.lit(".")).try_cast("double")


def parse_rating_count(c: Column) -> Column:
    """The number in brackets of ``4,7 (123)``."""
    return F.regexp_extract(c, "\\(([0-9]+)\\)", 1).try_cast("long")


def parse_stock(c: Column) -> Column:
    """The first digits, else 0."""
    return F.coalesce(F.regexp_extract(c.cast("string"), "([0-9]+)", 1).try_cast("long"), F.lit(0))


def discount_pct(original: Column, now: Column) -> Column:
    """Percent off, two decimals; null without a higher positive original."""
    return F.when((original > 0) & (original > now), F.round((original - now) / original * 100, 2))


def promo(prices: Column, least: float = 100.0) -> Column:
    """Struct (promo, price, original) of the listed prices in page order."""
    first, last = F.try_element_at(prices, F.lit(1)), F.try_element_at(prices, F.lit(-1))
    on = F.coalesce(first > last, F.lit(False))
    return F.struct(on.alias("promo"), F.array_min(F.filter(prices, lambda p: p >= least)).alias("price"), F.when(on, first).alias("original"))


def free_shipping(c: Column) -> Column:
    """Struct (free, cost) from a shipping text; the amount follows the word frete or envio, not letters inside another word."""
    t = F.lower(fold_ascii(F.lower(c)))
    free = F.coalesce(t.rlike(FREE_SHIPPING), F.lit(False))
    cost = parse_money(blank_to_null(F.regexp_extract(t, "(?<![a-z])(?:frete|envio)s?(?![a-z])[^0-9]*([0-9][0-9.,]*)", 1)))
    return F.struct(free.alias("free"), F.when(free, F.lit(0.0)).otherwise(cost).alias("cost"))


def ships_free(flag: Column, cost: Column) -> Column:
    """N8, row rule: flagged, and no cost or zero."""
    return F.coalesce(flag, F.lit(False)) & (F.coalesce(cost, F.lit(0.0)) == 0)


def weekday_of(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    """1 on Saturday and Sunday."""
    return F.coalesce(F.weekday(ts).isin(5, 6).cast("int"), F.lit(0))
