"""Column resolution, filters and the jobs that build clean and canonical listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerloom.config import COLUMN_ALIASES, DEFAULT, RECORD_ALIASES, MatchConfig
from offerloom.functions import attributes as E
from offerloom.functions import numbers as N
from offerloom.functions import text as T
from offerloom.functions.names import fresh
from offerloom.operators.dedup import dedup_global, dedup_listing, dedup_offers, latest_snapshot
from offerloom.operators.summary import canonical_summary, null_safe_join
from offerloom.sources.scratch import written


def resolve_columns(df: DataFrame, aliases: dict[str, tuple[str, ...]] = COLUMN_ALIASES) -> DataFrame:
    """For each canonical field the first alias that is a column, in any case; a null column if there is none.

    A blank marketplace is read off the url's domain, row by row.
    """
    by_name = {c.lower(): c for c in reversed(df.columns)}
    out = []
    for field, names in aliases.items():
        found = next((by_name[n.lower()] for n in names if n.lower() in by_name), None)
        out.append(F.col(f"`{found}`").alias(field) if found else F.lit(None).cast("string").alias(field))
    res = df.select(*out)
    if "marketplace" in aliases and "url" in aliases:
        res = res.withColumn("marketplace", F.coalesce(T.blank_to_null(F.col("marketplace").cast("string")), T.domain_label(F.col("url").cast("string"))))
    return res


def normalize_record(df: DataFrame, aliases: dict[str, tuple[str, ...]] = RECORD_ALIASES, source: str = "unknown", marketplace: str | None = None, query: Column | None = None, captured_at: Column | None = None) -> DataFrame:
    """Per row the first alias whose value is not blank, as the 15 columns of ``market_items``."""
    kinds = dict(df.dtypes)

    def pick(field: str, kind: str = "string") -> Column:
        found = [T.blank_to_null(F.col(f"`{n}`").cast("string")) for n in aliases[field] if n in kinds]
        return F.coalesce(*found, F.lit(None).cast("string"))

    def money(field: str) -> Column:
        found = [N.to_price(F.when(T.blank_to_null(F.col(f"`{n}`").cast("string")).isNotNull(), F.col(f"`{n}`")), kinds[n]) for n in aliases[field] if n in kinds]
        return F.coalesce(*found, F.lit(None).cast("double"))

    title, sku = pick("title"), F.coalesce(pick("sku"), pick("title"))
    taken = N.parse_ts(pick("captured_at"))
    return df.select(
        F.lit(source).alias("source"), F.lit(marketplace or source).alias("marketplace"), (F.lit(None).cast("string") if query is None else query).alias("query"),
        title.alias("title"), sku.alias("sku_text"), T.norm_sku(sku).alias("sku_norm"), money("price").alias("price"),
        F.coalesce(pick("currency"), F.lit("BRL")).alias("currency"), pick("condition").alias("condition"), pick("seller").alias("seller"), pick("url").alias("url"),
        money("shipping_price").alias("shipping_price"), N.to_double_safe(pick("stock")).alias("stock"), pick("location").alias("location"),
        (taken if captured_at is None else F.coalesce(taken, captured_at)).alias("captured_at"),
    )


def filter_listings(df: DataFrame, brand: str | None = None, size: str | None = None, model: str | None = None) -> DataFrame:
    """Rows whose brand, size and model equal the wanted ones after normalising."""
    for c, v in (("brand", brand), ("model", model)):
        if v is not None:
            df = df.where(T.norm_text(F.col(c)) == T.norm_text(F.lit(v)))
    if size is not None:
        plain = lambda c: F.coalesce(E.size_canonical(c), F.upper(F.trim(c)))
        df = df.where(plain(F.col("size")) == plain(F.lit(size)))
    return df


def fetch_groups(summary: DataFrame, brand: str | None = None, size: str | None = None, model: str | None = None) -> DataFrame:
    """Summary rows with exactly these values, by brand, size and model."""
    for c, v in (("brand", brand), ("size", size), ("model", model)):
        if v is not None:
            summary = summary.where(F.col(c) == v)
    return summary.orderBy("brand", "size", "model")


def discard_reason() -> Column:
    """P5: the first essential field that a row lacks; null for rows to keep."""
    return (
        F.when(T.is_blank(F.col("url")), "missing_url")
        .when(T.is_blank(F.col("title")), "missing_title")
        .when(F.coalesce(F.col("price") <= 0, F.lit(True)), "bad_price")
        .when(T.is_blank(F.col("marketplace")), "missing_marketplace")
    )


def essential_filter(df: DataFrame) -> DataFrame:
    """P5: rows with url, title, marketplace and a positive price."""
    return df.where(discard_reason().isNull())


def has_title_or_url(df: DataFrame) -> DataFrame:
    """Rows that have one of both."""
    return df.where(~(T.is_blank(F.col("title")) & T.is_blank(F.col("url"))))


def search_hit_reason(listings: DataFrame, terms: DataFrame, blocked_sellers: tuple[str, ...] = (), least_price: float = 100.0) -> DataFrame:
    """Each listing of a search with why it is dropped, or ``ok``.

    ``terms`` (term, brand, model) is joined to ``listings`` (term, title, price, url, seller, available). Checks, in this order:
    parse_fail, sem_dim, kit, marca_diff, modelo_diff, seller, indisponivel, preco, dup.
    """
    d = listings.join(terms.select("term", F.col("brand").alias("want_brand"), F.col("model").alias("want_model")), "term", "left")
    t = T.norm_text(F.col("title"))
    w = Window.partitionBy("term", "url").orderBy(F.col("price").asc_nulls_last(), "title")
    seller = F.lower(F.trim("seller")).isin(*[s.lower() for s in blocked_sellers]) if blocked_sellers else F.lit(False)
    reason = (
        F.when(T.is_blank(F.col("title")) | F.col("price").isNull(), "parse_fail")
        .when(~E.matches_dimension(F.col("title"), F.col("term")), "sem_dim")
        .when(E.is_kit(F.col("title")), "kit")
        .when(F.col("want_brand").isNotNull() & ~F.contains(t, T.norm_text(F.col("want_brand"))), "marca_diff")
        .when(F.col("want_model").isNotNull() & ~F.contains(t, T.norm_text(F.col("want_model"))), "modelo_diff")
        .when(seller, "seller")
        .when(F.col("available") == F.lit(False), "indisponivel")
        .when(F.col("price") < least_price, "preco")
        .when(F.row_number().over(w) > 1, "dup")
        .otherwise("ok")
    )
    return d.withColumn("reason", reason).drop("want_brand", "want_model")


def search_hit_filter(listings: DataFrame, terms: DataFrame, **options) -> DataFrame:
    """The listings whose reason is ``ok``."""
    return search_hit_reason(listings, terms, **options).where("reason = 'ok'").drop("reason")


def is_valid_listing(title: Column, price: Column, link: Column) -> Column:
    """P10: title, price and link all there; a price of zero is none."""
    return F.coalesce((F.trim(title) != "") & (price != 0) & (F.trim(link) != ""), F.lit(False))


def canonical_name(df: DataFrame) -> DataFrame:
    """A4: the most frequent title of each (marketplace, sku_norm); of equally frequent ones the first by name."""
    counts = df.where("title IS NOT NULL").groupBy("marketplace", "sku_norm", "title").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("marketplace", "sku_norm").orderBy(F.desc("n"), "title")
    return counts.withColumn("rn_", F.row_number().over(w)).where("rn_ = 1").select("marketplace", "sku_norm", F.col("title").alias("product_name"))


def with_canonical_name(df: DataFrame) -> DataFrame:
    """Each row with its product's canonical name; null keys match null keys."""
    market, sku = fresh(df, "market_", "sku_")
    names = canonical_name(df).withColumnsRenamed({"marketplace": market, "sku_norm": sku})
    return df.join(names, F.col("marketplace").eqNullSafe(F.col(market)) & F.col("sku_norm").eqNullSafe(F.col(sku)), "left").drop(market, sku)


def clean_market_items(items: DataFrame, sections: tuple[str, ...] = ("market_items_clean", "unifier_input", "products_dim", "discards")) -> dict[str, DataFrame]:
    """market_items_clean, unifier_input, products_dim and discards from ``market_items``, or those of ``sections``.

    The filled-in rows are written once, as the discards read them too, and so are the rows left without copies, from which the names
    are counted and to which they are joined; discards alone need no copies removed.
    """
    d = items.withColumn("url", T.unwrap_click_url(F.col("url")))
    known = T.blank_to_null(F.col("marketplace"))
    d = d.withColumn("marketplace", F.coalesce(F.when(known != "unknown", known), T.marketplace_from_url(F.col("url")), known))
    d = d.withColumn("title", F.coalesce(T.blank_to_null(F.col("title")), T.name_from_url(F.col("url")), T.name_from_query(F.col("query"))))
    d = d.withColumn("sku_norm", F.coalesce(T.blank_to_null(F.col("sku_norm")), T.norm_sku(F.col("title"))))
    kinds = dict(items.dtypes)
    d = d.withColumns({"captured_at": N.to_ts(F.col("captured_at"), kinds["captured_at"]), "price": N.to_double(F.col("price"), kinds["price"])})
    d = written(d.withColumn("captured_date", F.to_date("captured_at")), "filled")
    out = {"discards": d.withColumn("reason", discard_reason()).where("reason IS NOT NULL")}
    if set(sections) - {"discards"}:
        clean = with_canonical_name(written(dedup_offers(essential_filter(d), stored=True), "offers"))
        out |= {"market_items_clean": clean, "unifier_input": latest_snapshot(clean), "products_dim": clean.select("marketplace", "sku_norm", "product_name").dropDuplicates()}
    return {name: out[name] for name in sections}


def with_product(df: DataFrame, brands: tuple[str, ...] | None = None) -> DataFrame:
    """Brand, size, model_norm, product_signature and product_id of each row, from its title and sku_norm; the id needs no shuffle."""
    detect = (lambda c: E.detect_brand_substring(c, brands)) if brands else E.detect_brand_substring
    d = df.withColumn("size_str", E.size_parts(F.col("title"), F.col("sku_norm"))["size"])
    d = d.withColumn("brand", F.coalesce(detect(F.col("title")), detect(F.col("sku_norm"))))
    d = d.withColumn("model_norm", E.normalize_model(F.col("title"), F.col("brand"), F.col("size_str")))
    d = d.withColumn("product_signature", E.product_signature(F.col("brand"), F.col("size_str"), F.col("model_norm"), F.coalesce("sku_norm", "title")))
    return d.withColumn("product_id", E.product_id(F.col("product_signature")))


OFFER_COLUMNS = ("product_id", "marketplace", "title", "price", "seller", "url", "sku_norm", "captured_at", "currency", "condition", "shipping_price", "stock", "location")


def unify_products(df: DataFrame, brands: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """unified_products, unified_offers and unify_stats of the offers of all marketplaces."""
    from offerloom.operators.summary import products_agg, unify_stats

    for c in OFFER_COLUMNS[1:]:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    # Offers repeat their titles, so attributes are worked out once for each (title, sku_norm) and joined back.
    seen = df.groupBy("title", "sku_norm", "url").agg(F.count(F.lit(1)).alias("n_rows"), F.min("captured_at").alias("first_seen"), F.max("captured_at").alias("last_seen"))
    known = with_product(seen.select("title", "sku_norm").distinct(), brands)
    of_title = known.withColumnsRenamed({"title": "title_", "sku_norm": "sku_"})
    same = F.col("title").eqNullSafe(F.col("title_")) & F.col("sku_norm").eqNullSafe(F.col("sku_"))
    products = seen.join(of_title, same)
    offers = df.select(*OFFER_COLUMNS[1:]).join(of_title.select("title_", "sku_", "product_id"), same).select(*OFFER_COLUMNS)
    return {"unified_products": products_agg(products), "unified_offers": offers, "unify_stats": unify_stats(products)}


def with_attributes(df: DataFrame, config: MatchConfig = DEFAULT) -> DataFrame:
    """Brand, model, size and canonical_key of each row from its title and its raw brand, model and size.

    Listings repeat these texts (blank ones are null), so attributes are worked out once for each distinct lot of them and joined back.
    """
    raw = ["title", "brand_raw", "model_raw", "size_raw"]
    of = df.select(*raw).distinct()
    of = of.withColumn("brand", E.extract_brand(F.col("brand_raw"), F.col("title"), config))
    of = of.withColumn("model", E.extract_model(F.col("model_raw"), F.col("title"), F.col("brand"), config))
    of = of.withColumn("size", F.coalesce(T.blank_to_null(E.extract_size(F.col("size_raw"), F.col("title"))), E.extract_size_multi(F.col("title"))))
    of = of.withColumn("canonical_key", E.canonical_key(F.col("brand"), F.col("size"), F.col("model")))
    return null_safe_join(df.drop("brand", "model", "size", "canonical_key"), of.withColumnsRenamed({c: f"{c}_" for c in raw}), raw)


def _parsed(df: DataFrame) -> DataFrame:
    """Resolved columns (P1) with blank texts as nulls, and price, time and marketplace parsed."""
    raw = lambda c: T.blank_to_null(F.col(c).cast("string"))
    d = df.withColumns({c: raw(c) for c in ("title", "url", "seller", "brand_raw", "model_raw", "size_raw")})
    d = d.withColumns({"price": N.to_price(F.col("price"), dict(df.dtypes)["price"]), "collected_at": N.to_ts(F.col("collected_at"), dict(df.dtypes)["collected_at"])})
    label, own = T.domain_label(F.col("url")), raw("marketplace")
    return d.withColumn("marketplace", F.coalesce(F.when(~F.coalesce(F.lower(own) == F.lower("seller"), F.lit(False)), own), label, own))


LISTING_COLUMNS = ("marketplace", "title", "price", "url", "brand", "model", "size", "canonical_key", "collected_at", "seller", "source_file")


def build_canonical(df: DataFrame, config: MatchConfig = DEFAULT) -> DataFrame:
    """Canonical listings of resolved columns (P1): parsed price and time, brand, model, size and key; copies removed."""
    d = with_attributes(has_title_or_url(_parsed(df)), config)
    return dedup_listing(d.select(*LISTING_COLUMNS))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All frames one below the other; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def unify_marketplaces(frames: list[DataFrame], config: MatchConfig = DEFAULT, brand: str | None = None, size: str | None = None, model: str | None = None) -> dict[str, DataFrame]:
    """C4: unified_listings and canonical_summary of frames with any column names.

    Each frame is parsed by itself and rid of its copies; attributes are worked out for all frames at once. The listings are
    written, as the summary reads them too.
    """
    parsed = union_all([_parsed(resolve_columns(f)).withColumn("frame_", F.lit(k)) for k, f in enumerate(frames)])
    d = with_attributes(has_title_or_url(parsed), config).select(*LISTING_COLUMNS, "frame_")
    listings = dedup_global(dedup_listing(d, ["frame_"]).drop("frame_"))
    listings = written(filter_listings(listings, brand, size, model), "unified")
    return {"unified_listings": listings, "canonical_summary": canonical_summary(listings)}
