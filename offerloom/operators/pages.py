"""Listings from stored pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions import attributes as E
from offerloom.functions import numbers as N
from offerloom.config import KNOWN_BRANDS
from offerloom.functions.names import fresh
from offerloom.functions.text import blank_to_null
from offerloom.operators.dedup import keep_first_by

_ATTR = "[^>]*?(?:content|data-price|value)=[\"']([^\"']+)[\"']"


def _first(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


# Fields of JSON-LD that hold further nodes.
CONTAINERS = ("@graph", "itemListElement", "item", "mainEntity", "hasVariant")


def _as_list(v: Column, path: str) -> Column:
    """The variants at a path: the elements of an array, one value, or none."""
    one = F.try_variant_get(v, path, "variant")
    return F.when(one.isNull() | F.is_variant_null(one), F.array().cast("array<variant>")).otherwise(F.coalesce(F.try_variant_get(one, "$", "array<variant>"), F.array(one)))


def _children(v: Column) -> Column:
    return F.concat(*[_as_list(v, f"$['{c}']") for c in CONTAINERS])


def ld_products(html: Column, df: DataFrame, out: str, depth: int = 5) -> DataFrame:
    """``df`` with ``out``: the products (variants) of all JSON-LD blocks of a page, in the order of their levels.

    A block may be a node, a list of nodes, or nodes nested in graphs, item lists and variants, down to ``depth`` levels. Products are
    nodes of type Product and nodes with offers; text that is no JSON holds none.
    """
    levels = fresh(df, *[f"nodes{k}_" for k in range(depth + 1)])
    blocks = F.regexp_extract_all(html, F.lit("(?is)<script[^>]*application/ld\\+json[^>]*>(.*?)</script>"), 1)
    df = df.withColumn(levels[0], F.flatten(F.transform(blocks, lambda b: _as_list(F.try_parse_json(b), "$"))))
    for above, level in zip(levels, levels[1:]):
        df = df.withColumn(level, F.flatten(F.transform(above, _children)))
    kind = lambda v: F.transform(_as_list(v, "$['@type']"), lambda t: F.try_variant_get(t, "$", "string"))
    is_product = lambda v: F.exists(kind(v), lambda t: t.isin("Product", "ProductModel")) | F.try_variant_get(v, "$.offers", "variant").isNotNull()
    return df.withColumn(out, F.filter(F.concat(*levels), lambda v: F.coalesce(is_product(v), F.lit(False)))).drop(*levels)


def _offer(product: Column) -> Column:
    """(price, before, currency) of a product's first offer with a price; lists of offers may be nested in one."""
    text = lambda v, *paths: _first(*[F.try_variant_get(v, p, "string") for p in paths])
    offers = _as_list(product, "$.offers")
    every = F.flatten(F.transform(offers, lambda o: F.concat(F.array(o), _as_list(o, "$.offers"))))
    priced = F.transform(every, lambda o: F.struct(text(o, "$.price", "$.lowPrice", "$.priceSpecification.price").alias("price"), text(o, "$.highPrice").alias("before"), text(o, "$.priceCurrency", "$.priceSpecification.priceCurrency").alias("currency")))
    return F.coalesce(F.get(F.filter(priced, lambda o: o["price"].isNotNull()), 0), F.get(priced, 0))


def extract_listings_from_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """C20: title, price, price before, shipping and currency of each product of each stored page.

    Products come from the JSON-LD of the page (:func:`ld_products`), a row each. A page with one product or none is one row, in which
    price metadata and attributes, headings and the first amount in the text stand in for what the JSON-LD lacks. A price before stays
    only if it is higher. Pages without any give nulls.
    """
    (h,) = fresh(pages, "html_")
    d = pages.select(F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias(h))
    d = ld_products(F.col(h), d, "products_").withColumn("alone_", F.size("products_") <= 1)
    d = d.select("url", h, "alone_", F.explode_outer("products_").alias("product_")).withColumns({"offer_": _offer(F.col("product_")), "name_": _first(F.try_variant_get("product_", "$.name", "string"))})
    of_page = lambda *cols: F.when(F.col("alone_"), _first(*cols))
    text = F.regexp_replace(F.regexp_replace(h, "(?is)<(script|style)[^>]*>.*?</\\1>", " "), "(?s)<[^>]+>", " ")
    meta = of_page(F.regexp_extract(h, "(?is)<[^>]*(?:product:price:amount|itemprop=[\"']price[\"'])" + _ATTR, 1), F.regexp_extract(h, "(?is)data-price=[\"']([^\"']+)[\"']", 1))
    title = F.coalesce("name_", of_page(F.regexp_extract(h, "(?is)<h1[^>]*>(.*?)</h1>", 1), F.regexp_extract(h, "(?is)<title[^>]*>(.*?)</title>", 1)))
    raw = d.select(
        "url", "alone_", F.trim(F.regexp_replace(title, "(?s)<[^>]+>|\\s+", " ")).alias("title"), F.coalesce("offer_.price", meta).alias("p_"),
        F.coalesce("offer_.before", of_page(F.regexp_extract(h, "(?is)<(?:del|s)\\b[^>]*>[^0-9<]*([0-9][0-9.,]*)", 1))).alias("b_"), F.col("offer_.currency").alias("currency"), text.alias("t_"),
    )
    in_text = F.when(F.col("alone_"), N.parse_money(F.col("t_"), "search"))
    d = raw.withColumns({"price": F.coalesce(N.parse_money(F.col("p_")), in_text), "b_": N.parse_money(F.col("b_")), "s_": N.free_shipping(F.col("t_"))})
    d = d.withColumn("previous_price", F.when(F.col("b_") > F.col("price"), F.col("b_")))
    return d.select("url", "title", "price", "previous_price", N.discount_pct(F.col("previous_price"), F.col("price")).alias("discount_pct"), "currency", F.col("s_.free").alias("free_shipping"), F.col("s_.cost").alias("shipping_price"))


def enrich_listings(listings: DataFrame, details: DataFrame, brands: tuple[str, ...] = KNOWN_BRANDS) -> DataFrame:
    """Listings with what their detail page (same url) adds: a lower price, and size and brand where these are blank.

    Of several details of one url the cheapest counts, then the first by title.
    """
    url, title, price = fresh(listings, "url_", "detail_title", "detail_price")
    d = details.select(F.col("url").alias(url), F.col("title").alias(title), F.col("price").alias(price))
    d = keep_first_by(d, [url], [F.col(price).asc_nulls_last()])
    out = listings.join(d, F.col("url") == F.col(url), "left").withColumn("price", F.least("price", price))
    if "size" in listings.columns:
        out = out.withColumn("size", F.coalesce(blank_to_null(F.col("size")), E.size_canonical(F.col(title))))
    if "brand" in listings.columns:
        out = out.withColumn("brand", F.coalesce(blank_to_null(F.col("brand")), E.detect_brand_substring(F.col(title), brands)))
    return out.select(*listings.columns)


def spec_map(names: Column, values: Column) -> Column:
    """A map from arrays of attribute names and values; of a repeated name the first value."""
    pairs = F.filter(F.zip_with(names, values, lambda k, v: F.struct(k.alias("k"), v.alias("v"))), lambda p: p["k"].isNotNull())
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.get(F.filter(pairs, lambda p: p["k"] == k), 0)["v"]))
