"""Product attributes from titles: size, brand, model, keys and kit words."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.config import DEFAULT, GENERIC_MODEL_TOKENS, KNOWN_BRANDS, MODEL_STOP_WORDS, MatchConfig
from offerloom.functions.text import blank_to_null, fold_ascii, let, norm_text

# Ways to write a tyre size. Groups: width, aspect, rim.
SIZE = "([0-9]{3})\\s*[/ -]\\s*([0-9]{2,3})\\s*[rR]?\\s*[- ]?\\s*([0-9]{2})"
SIZE_FORMS = (
    "(?<![0-9])([0-9]{3})\\s*[/xX-]\\s*([0-9]{2})\\s*[zZ]?[rRzZ][fF]?\\s*-?\\s*([0-9]{2})(?![0-9])",
    "(?<![0-9])([0-9]{3})\\s*[/-]\\s*([0-9]{2})\\s*([0-9]{2})(?![0-9])",
    "(?<![0-9])([0-9]{3})([0-9]{2})[zZ]?[rRzZ][fF]?([0-9]{2})(?![0-9])",
)
OFF_ROAD = "(?<![0-9])([0-9]{2})\\s*[xX]\\s*([0-9]{2}\\.?[0-9]*)\\s*[rR]\\s*([0-9]{2})(?![0-9])"
SIZE_PARTS = "([0-9]{3})\\s*[/ ]\\s*([0-9]{2})\\s*[Rr]\\s*([0-9]{2})"
SIZE_LOOSE = "([0-9]{3})[\\s/-]*([0-9]{2})[\\s/-]*[rR]?[\\s/-]*([0-9]{2})"
LOAD_SPEED = "(?i)\\b[0-9]{2,3}\\s*[a-z]{1,2}\\b"
TOKENS = "[a-z0-9]+|[^a-z0-9]"
# Words that tell an offer of several units.
KIT_WORDS = "kit|kits|conjunto|jogo|par|pares|dupla|combo|fechamento|lote|unidades|caixa|pack|pacote"
KIT_COUNTS = "[24]\\s*x?\\s*pneus?|duas?\\s*pneus?|[24]\\s*unid?|4uni|k[0-9]{1,2}|(?:[24568]|10)x|x[2468]"
KIT_PATTERN = f"(?i)(?<![a-z0-9])(?:{KIT_WORDS}|{KIT_COUNTS})(?![a-z0-9])"


def _size(text: Column, pattern: str, sep: str = "/", mark: str = "R") -> Column:
    a, b, c = (F.regexp_extract(text, pattern, k) for k in (1, 2, 3))
    return F.when(a != "", F.concat(a, F.lit(sep), b, F.lit(mark), c))


def extract_size(*texts: Column) -> Column:
    """``205/55R16`` from the first text that holds a size; '' if none does."""
    return F.coalesce(*[_size(norm_text(t), SIZE) for t in texts], F.lit(""))


def extract_size_multi(text: Column) -> Column:
    """The size by the first of four forms that fits, off-road sizes (``31X10.5R15``) included; '' if none does."""
    t = F.coalesce(text, F.lit(""))
    return F.coalesce(*[_size(t, p) for p in SIZE_FORMS], F.upper(_size(t, OFF_ROAD, "X")), F.lit(""))


def size_parts(title: Column, sku: Column | None = None) -> Column:
    """Struct (width, aspect, rim, size) from the title, else from the SKU; null fields if neither has a size."""

    def one(c: Column) -> Column:
        t = F.translate(c, "-_.", "   ")
        g = [F.regexp_extract(t, SIZE_PARTS, k) for k in (1, 2, 3)]
        return F.when(g[0] != "", F.struct(g[0].alias("width"), g[1].alias("aspect"), g[2].alias("rim"), F.concat(g[0], F.lit("/"), g[1], F.lit("R"), g[2]).alias("size")))

    return one(title) if sku is None else F.coalesce(one(title), one(sku))


def size_canonical(text: Column) -> Column:
    """``175/70R13`` with any or no separators; null if there is no size."""
    return _size(F.coalesce(text, F.lit("")), SIZE_LOOSE)


def size_folder(text: Column, default: str = "medida_desconhecida") -> Column:
    """``175-70-r13``, or ``default``."""
    return F.coalesce(_size(F.coalesce(text, F.lit("")), SIZE_LOOSE, "-", "-r"), F.lit(default))


def rim(text: Column) -> Column:
    """The rim after an R, as a number."""
    return F.regexp_extract(text, "[rR]\\s*([0-9]{2})(?![0-9])", 1).try_cast("int")


def _lookup(t: Column, table: dict[str, str]) -> Column:
    """The table's value for a text, null for other texts: a hash test first, as a map is searched key by key."""
    if not table:
        return F.lit(None).cast("string")
    return F.when(t.isin(*table), F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), t))


def _grams(tokens: Column, words: tuple[str, ...], split: Callable[[str], list[str]], sep: str) -> Column:
    """The dictionary's entries that a text holds: its runs of as many tokens as the entries have, looked up in one hash set."""

    def of(n: int) -> Column:
        return tokens if n == 1 else F.transform(tokens, lambda _, i: F.array_join(F.slice(tokens, i + 1, n), sep))

    runs = [of(n) for n in sorted({len(split(w)) for w in words})]
    return F.filter(F.concat(*runs), lambda g: g.isin(*words))


def _first_of(found: Column, words: tuple[str, ...]) -> Column:
    """Of the entries found, the one that is first in the dictionary."""
    if list(words) == sorted(words):
        return F.array_min(found)
    rank = F.create_map(*[x for i, w in enumerate(words) for x in (F.lit(w), F.lit(i))])
    return F.array_min(F.transform(found, lambda g: F.struct(F.try_element_at(rank, g).alias("rank"), g.alias("word"))))["word"]


def _first_token_in(t: Column, words: tuple[str, ...]) -> Column:
    """The first of ``words`` that stands in the text (single spaces, none at the ends) between spaces."""
    if not words:
        return F.lit(None).cast("string")
    return let(F.split(t, " "), lambda tokens: _first_of(_grams(tokens, words, lambda w: w.split(" "), " "), words))


def _alias_in(t: Column, aliases: dict[str, str]) -> Column:
    return _lookup(_first_token_in(t, tuple(aliases)), aliases)


def canon_brand(c: Column, config: MatchConfig = DEFAULT) -> Column:
    """E5: by alias, by known name, by known name inside, else the first word; '' for nothing."""
    return let(norm_text(c), lambda t: F.coalesce(_lookup(t, config.brand_aliases), F.when(t.isin(*config.brands), t) if config.brands else F.lit(None), _first_token_in(t, config.brands), F.split(t, " ")[0]))


def extract_brand(brand_raw: Column, title: Column, config: MatchConfig = DEFAULT, alias_first: bool = False) -> Column:
    """The given brand in canonical form, else a known brand or alias in the title; '' if there is none."""

    def in_title(t: Column) -> Column:
        found = [_first_token_in(t, config.brands), _alias_in(t, config.brand_aliases)]
        return F.coalesce(*(found[::-1] if alias_first else found), F.lit(""))

    return F.coalesce(blank_to_null(canon_brand(brand_raw, config)), let(norm_text(title), in_title))


def detect_brand_substring(c: Column, brands: tuple[str, ...] = KNOWN_BRANDS, expected: Column | None = None) -> Column:
    """The longest brand that is part of the text (equal lengths by name); an expected brand that occurs wins; null if none."""
    t = F.lower(c)
    ordered = sorted(set(brands), key=lambda b: (-len(b), b))
    found = F.coalesce(*[F.when(F.contains(t, F.lit(b)), b) for b in ordered], F.lit(None).cast("string"))
    if expected is not None:
        found = F.when(F.contains(t, F.lower(expected)), F.lower(expected)).otherwise(found)
    return F.replace(found, F.lit("-"), F.lit(" "))


def canon_model(c: Column, config: MatchConfig = DEFAULT, strip_codes: bool = False) -> Column:
    """By alias, else normalised; ``strip_codes`` also drops rims, load-speed codes and construction words."""
    t = norm_text(c)
    out = F.coalesce(_lookup(t, config.model_aliases), t)
    if strip_codes:
        out = F.regexp_replace(out, "\\b(?:r[0-9]{2}|[0-9]{2,3}[hvtwyz]|xl|tl|tt|runflat|rft)\\b", " ")
        out = F.regexp_replace(F.trim(F.regexp_replace(out, " +", " ")), "^[ /_-]+|[ /_-]+$", "")
    return out


def _phrase_in(t: Column, brand: Column, config: MatchConfig) -> Column:
    """The canonical form of the first known phrase in the text, no letter or digit beside it, that isn't the brand."""
    # Letters and digits run together, anything else is a token of its own, so phrases may hold slashes and hyphens.
    simple = tuple(p for p in config.model_phrases if re.match("[a-z0-9](?:.*[a-z0-9])?$", p))
    odd = tuple(p for p in config.model_phrases if p not in simple)
    alone = lambda p: F.rlike(t, F.lit(f"(?<![a-z0-9]){re.escape(p)}(?![a-z0-9])"))
    canonical = lambda p: F.coalesce(_lookup(p, config.model_aliases), p)

    def first(tokens: Column) -> Column:
        found = _grams(tokens, simple, lambda p: re.findall(TOKENS, p), "") if simple else F.array().cast("array<string>")
        if odd:
            found = F.concat(found, *[F.when(alone(p), F.array(F.lit(p))).otherwise(F.array().cast("array<string>")) for p in odd])
        return canonical(_first_of(F.filter(found, lambda p: canonical(p) != brand), config.model_phrases))

    return let(F.regexp_extract_all(t, F.lit(f"({TOKENS})"), 1), first)


def _words_after(t: Column, brand: Column, config: MatchConfig, tokens: int) -> Column:
    """The first words after the brand and before a size, without stop words, in canonical form; null without the brand."""
    spaced, wanted = F.concat(F.lit(" "), t, F.lit(" ")), F.concat(F.lit(" "), brand, F.lit(" "))
    after = F.when((brand != "") & F.contains(spaced, wanted), F.substr(spaced, F.instr(spaced, wanted) + F.length(brand) + 2))

    def guess(after: Column) -> Column:
        cut = after
        for p in reversed((*SIZE_FORMS, OFF_ROAD)):  # the first form that fits is the one that cuts
            cut = F.when(after.rlike(p), F.regexp_replace(after, f"(?s){p}.*$", "")).otherwise(cut)
        words = F.filter(F.split(F.regexp_replace(cut, "[/_,-]+", " "), " +"), lambda w: (w != "") & ~w.isin(*MODEL_STOP_WORDS))
        return F.array_join(F.slice(words, 1, tokens), " ")

    return let(let(after, guess), lambda g: F.coalesce(_lookup(g, config.model_aliases), g))


def extract_model(model_raw: Column, title: Column, brand: Column, config: MatchConfig = DEFAULT, tokens: int = 3) -> Column:
    """The given model unless it is the brand; else the longest known phrase in the title; else the words after the brand.

    Phrases and words go through the model aliases before they are held against the brand. The words after the brand end at a size,
    and stop words are left out. '' if nothing remains.
    """
    b = F.coalesce(brand, F.lit(""))

    def in_title(t: Column) -> Column:
        return F.coalesce(_phrase_in(t, b, config) if config.model_phrases else F.lit(None), let(_words_after(t, b, config, tokens), lambda g: F.when(g != b, g)), F.lit(""))

    found = let(norm_text(title), in_title)
    return let(canon_model(model_raw, config), lambda given: F.when(given != "", F.when(given == b, "").otherwise(given)).otherwise(found))


def normalize_model(title: Column, brand: Column, size: Column) -> Column:
    """The title without size, load and speed codes, brand and generic words."""
    t = F.lower(F.coalesce(title, F.lit("")))
    s = F.lower(F.coalesce(size, F.lit("")))
    t = F.when(s != "", F.replace(F.replace(t, s, F.lit(" ")), F.replace(s, F.lit("/"), F.lit(" ")), F.lit(" "))).otherwise(t)
    t = F.regexp_replace(F.regexp_replace(t, SIZE_PARTS, " "), LOAD_SPEED, " ")
    b = F.lower(F.coalesce(brand, F.lit("")))
    t = F.when(b != "", F.replace(t, b, F.lit(" "))).otherwise(t)
    words = F.filter(F.split(F.regexp_replace(t, "[^0-9a-zA-Z]+", " "), " "), lambda w: (w != "") & ~w.isin(*GENERIC_MODEL_TOKENS))
    return F.array_join(words, " ")


def product_signature(brand: Column, size: Column, model: Column, fallback: Column) -> Column:
    """Brand, size and model joined by pipes with ``unk`` for what is missing; with two missing, ``fb`` and the fallback text."""
    parts = [blank_to_null(x) for x in (brand, size, model)]
    missing = sum((p.isNull().cast("int") for p in parts), F.lit(0))
    base = F.concat_ws("|", *[F.coalesce(F.trim(p), F.lit("unk")) for p in parts])
    fb = F.trim(F.regexp_replace(F.coalesce(fallback, F.lit("")), "[^0-9a-zA-Z]+", " "))
    return F.regexp_replace(F.when((missing >= 2) & (fb != ""), F.concat(F.lit("fb|"), F.lower(fb))).otherwise(base), "\\s+", " ")


def product_id(signature: Column) -> Column:
    """The first 16 hex digits of the signature's SHA-1."""
    return F.substring(F.sha1(signature), 1, 16)


def canonical_key(brand: Column, size: Column, model: Column) -> Column:
    """Trimmed brand, size and model joined by pipes, no pipes at the ends."""
    parts = [F.trim(F.coalesce(x, F.lit(""))) for x in (brand, size, model)]
    return F.regexp_replace(F.concat(parts[0], F.lit("|"), parts[1], F.lit("|"), parts[2]), "^\\|+|\\|+$", "")


def is_kit(title: Column) -> Column:
    """The title offers several units."""
    return F.coalesce(fold_ascii(F.lower(title)).rlike(KIT_PATTERN), F.lit(False))


def search_filters(term: Column, brands: tuple[str, ...] = KNOWN_BRANDS, config: MatchConfig = DEFAULT) -> Column:
    """Struct (size, brand, model) that a search term asks for; null fields where it doesn't."""
    return F.struct(size_canonical(term).alias("size"), detect_brand_substring(term, brands).alias("brand"), _first_token_in(norm_text(term), config.model_phrases).alias("model"))


def matches_dimension(title: Column, term: Column) -> Column:
    """The term's first three numbers stand in the title as one size; true if the term has fewer."""
    n = F.regexp_extract_all(term, F.lit("([0-9]+)"), 1)
    gap = "[\\s/-]*"
    pattern = F.concat(F.lit("(?i)\\b"), n[0], F.lit(gap), F.get(n, 1), F.lit(f"{gap}r?{gap}"), F.get(n, 2), F.lit("\\b"))
    return F.when(F.size(n) < 3, True).otherwise(F.coalesce(F.regexp_like(title, pattern), F.lit(False)))


def flexible_query(width: Column, aspect: Column, rim_: Column, brand: Column, line: Column) -> Column:
    """``pneu 175 70 r13 brand line`` from the parts that are there."""
    return F.concat_ws(" ", F.lit("pneu"), width.cast("string"), aspect.cast("string"), F.concat(F.lit("r"), rim_.cast("string")), F.lower(brand), F.lower(line))


