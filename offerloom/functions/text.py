"""Column functions on text, names and URLs."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.config import GENERIC_NAMES


def _accents() -> tuple[str, str]:
    """Latin letters that decompose to one ASCII letter, and these letters."""
    found = [(c, unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()) for c in map(chr, [*range(0xAA, 0x250), *range(0x1E00, 0x1F00)])]
    pairs = [(c, a) for c, a in found if len(a) == 1]
    return "".join(c for c, _ in pairs), "".join(a for _, a in pairs)


_FROM, _TO = _accents()


def blank_to_null(c: Column) -> Column:
    """Null for a text that is empty or only white space."""
    return F.when(F.trim(c) != "", c)


def is_blank(c: Column) -> Column:
    """Null, or empty after trimming."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def fold_ascii(c: Column) -> Column:
    """Accents removed, other characters outside ASCII dropped; a text of one byte a character is left as it is."""
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.regexp_replace(F.translate(c, _FROM, _TO), "[^\\x00-\\x7F]", ""))


def norm_text(c: Column) -> Column:
    """Lower case, ASCII, only ``[a-z0-9 /-]``, single spaces; null becomes ''."""
    t = fold_ascii(F.lower(F.coalesce(c.cast("string"), F.lit(""))))
    return F.trim(F.regexp_replace(t, "[^a-z0-9/-]+", " "))


def norm_text_keep_dots(c: Column) -> Column:
    """Lower case without accents; word characters, ``/``, ``.`` and ``-`` stay."""
    t = F.regexp_replace(F.translate(F.coalesce(c.cast("string"), F.lit("")), _FROM, _TO), "\\p{M}", "")
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(t, "[^\\p{L}\\p{N}_\\s/.-]", " "), "\\s+", " ")))


def norm_txt_ws(c: Column) -> Column:
    """Lower case, ASCII, white space squeezed; punctuation stays."""
    return F.trim(F.regexp_replace(fold_ascii(F.lower(F.coalesce(c.cast("string"), F.lit("")))), "\\s+", " "))


def norm_sku(c: Column) -> Column:
    """T4: upper case, runs of other characters become ``-``, none at the ends; null stays null."""
    return F.regexp_replace(F.regexp_replace(F.upper(c), "[^0-9A-Z]+", "-"), "^-+|-+$", "")


def slugify(c: Column, sep: str = "-", max_len: int | None = None, default: str | None = None) -> Column:
    """T5: ASCII words joined by ``sep``, cut to ``max_len``; ``default`` for what leaves nothing."""
    t = F.regexp_replace(fold_ascii(F.lower(c)), "[^a-z0-9]+", sep)
    if max_len:
        t = F.substring(F.regexp_replace(t, f"^{sep}+", ""), 1, max_len)
    t = F.regexp_replace(t, f"^{sep}+|{sep}+$", "")
    return t if default is None else F.coalesce(blank_to_null(t), F.lit(default))


def safe_part(c: Column, default: str = "NA") -> Column:
    """A value for a partition path; null and empty become ``default``."""
    t = F.regexp_replace(F.regexp_replace(F.trim(c.cast("string")), "[/\\\\]", "-"), "\\s+", "-")
    t = F.regexp_replace(F.regexp_replace(t, "[^a-zA-Z0-9_.=-]+", "-"), "^-+|-+$", "")
    return F.coalesce(blank_to_null(t), F.lit(default))


# Hosts of click tracking and their parameters, path segments and words that name no product, file endings.
CLICK_HOST = "^click.*mercadolivre\\.com"
CLICK_PARAMETERS = ("url", "u", "redirect", "redirectUrl", "dest", "go", "to")
PLAIN_SEGMENT = "(?i)^(ml[balmcuv]-?[0-9]+|p|produtos?|products?)$"
PAGE_ENDING = "(?i)\\.(html?|php|aspx|jsp|json|xml|jm)$"
ITEM_CODE = "(?i)^ml[balmcuv]-?[0-9]+"
SALES_WORDS = "(?i)\\b(oficial|original|novo|usado|frete|gratis|grátis)\\b"
SEARCH_ENDING = "(?i)(_[0-9]{8}_[0-9]{6})?\\.(json|csv|txt)$"


def unwrap_click_url(url: Column) -> Column:
    """The target in the redirect parameters of a click-tracking link; other links stay."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    target = F.coalesce(*[F.try_parse_url(url, F.lit("QUERY"), F.lit(k)) for k in CLICK_PARAMETERS])
    return F.when(host.rlike(CLICK_HOST), F.coalesce(F.try_url_decode(target), url)).otherwise(url)


def name_from_url(url: Column) -> Column:
    """A readable name from the last useful path segment, or null."""
    path = F.try_url_decode(F.try_parse_url(unwrap_click_url(url), F.lit("PATH")))
    return let(let(F.filter(F.split(path, "/"), lambda s: s != ""), _useful_segment), lambda s: _title(_without_codes(s)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _useful_segment(seg: Column) -> Column:
    last, before = F.try_element_at(seg, F.lit(-1)), F.try_element_at(seg, F.lit(-2))
    skip = last.rlike(PLAIN_SEGMENT)
    return F.when(skip & before.isNotNull(), before).otherwise(last)


def _without_codes(s: Column) -> Column:
    s = F.replace(F.regexp_replace(s, PAGE_ENDING, ""), F.lit("_JM"), F.lit(""))
    s = F.regexp_replace(F.regexp_replace(s, ITEM_CODE, ""), "^[-_]+", "")
    return F.regexp_replace(F.regexp_replace(s, "[-_]+", " "), SALES_WORDS, "")


def name_from_query(query: Column) -> Column:
    """A readable name from the file name of a search."""
    base = F.regexp_replace(query, SEARCH_ENDING, "")
    return _title(F.regexp_replace(base, "[-_]+", " "))


def _title(s: Column) -> Column:
    return let(F.lower(F.trim(F.regexp_replace(s, "\\s+", " "))), lambda t: F.when((F.length(t) >= 4) & ~t.isin(*GENERIC_NAMES), F.initcap(t)))


def marketplace_from_url(url: Column) -> Column:
    """Canonical name of known shops, else the host without port."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return (
        F.when(F.contains(host, F.lit("mercadolivre.com")), "mercadolivre")
        .when(F.contains(host, F.lit("magazineluiza.com.br")) | F.contains(host, F.lit("magalu.com")), "magalu")
        .when(F.contains(host, F.lit("pneustore.com.br")), "pneustore")
        .otherwise(host)
    )


def domain_label(url: Column) -> Column:
    """The first label of an http(s) host after ``www.``, or null."""
    return blank_to_null(F.regexp_extract(F.lower(url), "https?://(?:www\\.)?([a-z0-9-]+)\\.", 1))


def url_norm(url: Column) -> Column:
    """Trimmed, lower case, without fragment."""
    return F.regexp_replace(F.lower(F.trim(url)), "#.*$", "")


def link_clean(url: Column, base: str = "") -> Column:
    """Cut at ``?`` or ``#``; a relative link gets ``base`` before it."""
    cut = F.substring_index(F.substring_index(url, "#", 1), "?", 1)
    return F.when(F.startswith(cut, F.lit("/")), F.concat(F.lit(base), cut)).otherwise(cut)


def asin(url: Column) -> Column:
    """The ten-character id after ``/dp/``, or null."""
    return blank_to_null(F.regexp_extract(url, "/dp/([A-Z0-9]{10})", 1))
