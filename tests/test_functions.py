"""Column functions on the small cases of the fixtures."""

import random
import re

import pytest
from pyspark.sql import functions as F

from offerloom.config import DEFAULT, MODEL_STOP_WORDS, MatchConfig
from offerloom.functions import attributes as E
from offerloom.functions import numbers as N
from offerloom.functions import text as T


def one(spark, col, *values):
    """The column's value over one row of texts a, b, c."""
    names = "abc"[: len(values)]
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return df.select(col(*[F.col(n) for n in names]).alias("x")).first().x


@pytest.mark.parametrize("text, want", [("R$ 1.234,56", 1234.56), ("1234.5", 1234.5), ("1.234", 1234.0), ("351.9", 351.9), ("abc", None), (None, None), ("", None)])
def test_money_auto_tail(spark, text, want):
    assert one(spark, N.parse_money, text) == want


@pytest.mark.parametrize("style, text, want", [("br", "351.9", 3519.0), ("auto", "1.234", 1.234), ("search", "por R$ 1.234,56 no pix", 1234.56), ("search", "sem preço", None)])
def test_money_styles(spark, style, text, want):
    assert one(spark, lambda c: N.parse_money(c, style), text) == want


def test_numbers(spark):
    assert one(spark, N.money_parts, "1.234", "5") == 1234.05
    assert one(spark, N.parse_stock, "restam 7 peças") == 7 and one(spark, N.parse_stock, None) == 0
    assert one(spark, N.parse_rating, "4,7 (123)") == 4.7 and one(spark, N.parse_rating_count, "4,7 (123)") == 123
    assert one(spark, N.to_double_safe, "NaN") is None and one(spark, N.to_double_safe, " 2.5 ") == 2.5
    assert one(spark, N.free_shipping, "Frete grátis").asDict() == {"free": True, "cost": 0.0}
    assert one(spark, N.free_shipping, "frete R$ 12,50").cost == 12.5
    assert str(one(spark, N.parse_ts, "12/08/2025 10:00:00")) == "2025-08-12 10:00:00" and one(spark, N.parse_ts, "never") is None


@pytest.mark.parametrize("raw, title, want", [("205/55R16", "", "205/55R16"), (None, "Pneu 195 65 r15 Goodyear", "195/65R15"), (None, "no size", "")])
def test_size(spark, raw, title, want):
    assert one(spark, E.extract_size, raw, title) == want


@pytest.mark.parametrize("text, want", [("195/55ZR16", "195/55R16"), ("31x10.5R15", "31X10.5R15"), ("19555R16", "195/55R16"), ("", ""), (None, "")])
def test_size_forms(spark, text, want):
    assert one(spark, E.extract_size_multi, text) == want


def test_brand_and_model(spark):
    assert one(spark, E.extract_brand, "Goodyear", "") == "goodyear"
    assert one(spark, E.extract_brand, None, "Pneu Dunlop 205/55R16") == "dunlop"
    assert one(spark, E.extract_model, None, "Pneu Goodyear Assurance MaxLife 205/55R16", "goodyear") in ("assurance", "assurance maxlife")
    assert one(spark, E.extract_model, None, "Dunlop SP Touring FM800 195/65R15 91H", "dunlop") in ("sp touring", "fm800")
    assert one(spark, E.extract_model, "dunlop", "x", "dunlop") == ""
    assert one(spark, lambda a: E.canon_model(a, DEFAULT, True), "Primacy 4 91H XL") == "primacy 4"


def plain_brand(raw, t, config):
    """E5 and E6 word by word, of texts that are normalised already."""
    inside = lambda words, t: next((w for w in words if f" {w} " in f" {t} "), None)
    found = config.brand_aliases.get(raw) or inside(config.brands, raw) or raw.split(" ")[0]
    return found or inside(config.brands, t) or config.brand_aliases.get(inside(config.brand_aliases, t)) or ""


def plain_model(raw, t, brand, config):
    """E9, likewise."""
    canon = lambda m: config.model_aliases.get(m, m)
    if raw:
        return "" if canon(raw) == brand else canon(raw)
    for p in config.model_phrases:
        if re.search(f"(?<![a-z0-9]){re.escape(p)}(?![a-z0-9])", t) and canon(p) != brand:
            return canon(p)
    if brand and f" {brand} " in f" {t} ":
        after = f" {t} ".split(f" {brand} ", 1)[1]
        cut = next((m for m in (re.search(p, after) for p in (*E.SIZE_FORMS, E.OFF_ROAD)) if m), None)
        words = re.sub("[/_,-]+", " ", after[: cut.start()] if cut else after).split()
        guess = canon(" ".join([w for w in words if w not in MODEL_STOP_WORDS][:3]))
        return "" if guess == brand else guess
    return ""


def test_dictionaries_against_plain_search(spark):
    rng = random.Random(3)
    words = ["kelly", "edge", "sp", "sport", "p400", "evo", "good", "year", "dun", "lop", "x", "a-b", "175/70", "r13", "19555r16", "31x10 r15", "pneu", "/70"]
    text = lambda n: " ".join(rng.choices(words, k=rng.randrange(n)))
    config = MatchConfig.of(
        ["good year", "dun", "lop", "sp sport", "kelly"] + [f"b{k}" for k in range(20)], {"year": "good year", "x edge": "lop", "evo": "kelly"},
        ["kelly edge", "sp sport", "p400 evo", "p400", "a-b", "b sp", "/70", "kelly", "edge sp sport"], {"p400": "dun", "edge": "kelly", "a-b": "ab"},
    )
    rows = [(i, text(3), text(9), text(3)) for i in range(1500)]
    df = spark.createDataFrame(rows, "i int, raw string, title string, model string")
    df = df.withColumn("brand", E.extract_brand(F.col("raw"), F.col("title"), config))
    df = df.withColumn("found", E.extract_model(F.col("model"), F.col("title"), F.col("brand"), config))
    got = {r.i: (r.brand, r.found) for r in df.collect()}
    for i, raw, title, model in rows:
        brand = plain_brand(raw, title, config)
        assert got[i] == (brand, plain_model(model, title, brand, config)), (raw, title, model)
    assert {b for b, _ in got.values()} >= {"good year", "lop", "kelly", ""} and {m for _, m in got.values()} >= {"dun", "ab", "/70"}


@pytest.mark.parametrize("text, want", [("Kit 2 pneus aro 13", True), ("2 pneus 175/70", True), ("Pneu 175/70R13", False), ("pneu parcelado", False), (None, False)])
def test_kit(spark, text, want):
    assert one(spark, E.is_kit, text) is want


def test_keys(spark):
    assert one(spark, E.canonical_key, " a ", None, "m") == "a||m" and one(spark, E.canonical_key, None, None, "m") == "m"
    sig = one(spark, lambda a, b, c: E.product_signature(a, b, F.lit(None), c), "dunlop", None, "SKU-1")
    assert sig == "fb|sku 1"
    assert one(spark, E.matches_dimension, "Pneu 175/70 R13 82T", "175-70-r13 pirelli") is True
    assert one(spark, E.matches_dimension, "Pneu 185/70 R13", "175-70-r13") is False


def test_text(spark):
    assert one(spark, T.norm_text, "  Pneu RADIAL, ação! ") == "pneu radial acao"
    assert one(spark, T.slugify, "Ação & Reação") == "acao-reacao"
    assert one(spark, T.safe_part, None) == "NA" and one(spark, T.safe_part, "175/70 R13") == "175-70-R13"
    assert one(spark, T.unwrap_click_url, "https://click1.mercadolivre.com.br/x?url=https%3A%2F%2Fa.b%2Fc") == "https://a.b/c"
    assert one(spark, T.name_from_url, "https://x.com/pneu-aro-13-pirelli/MLB-123456") == "Pneu Aro 13 Pirelli"
    assert one(spark, T.name_from_query, "pneu-185-60-r14-dunlop_20250808_101010.json") == "Pneu 185 60 R14 Dunlop"
    assert one(spark, T.marketplace_from_url, "https://produto.mercadolivre.com.br/x") == "mercadolivre"
    assert one(spark, T.asin, "https://a.com/x/dp/B0ABCDEFGH?ref=1") == "B0ABCDEFGH" and one(spark, T.asin, "https://a.com") is None
