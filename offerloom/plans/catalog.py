"""Registered queries of the price engine and their DuckDB counterparts.

Each query applies an operator to whole tables (see ``views``). Dates and times leave as text, so both engines agree on their type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.config import MatchConfig
from offerloom.functions import attributes as E
from offerloom.functions import numbers as N
from offerloom.functions import text as T
from offerloom.operators import audit, dedup, listings, pages, pricing, quality, series, summary
from offerloom.plans import views
from offerloom.plans.views import table, with_views
from offerloom.sources.scratch import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, *of: str):
    """Register a function as query ``name``; ``sql`` may use the views ``of``."""

    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = with_views(sql, *of) if of else sql
        return f

    return register


DEC = "cast(sum(cast({0} AS decimal(18,2))) AS double) / count({0})"
MEAN = DEC.format("price")
ROW = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
SUMMARY = f"""
    keyed AS (SELECT canonical_key, brand, model, size, count(*) AS n_listings, count(price) AS n_prices,
        coalesce(string_agg(DISTINCT marketplace, ',' ORDER BY marketplace) FILTER (trim(marketplace) <> ''), '') AS m,
        coalesce(string_agg(DISTINCT source_file, ',' ORDER BY source_file) FILTER (trim(source_file) <> ''), '') AS evidence_files,
        min(price) AS min_price, max(price) AS max_price, {MEAN} AS mean_price,
        round(quantile_cont(price, 0.5), 6) AS median_price, round(quantile_cont(price, 0.1), 6) AS p10, round(quantile_cont(price, 0.9), 6) AS p90
        FROM {{0}} GROUP BY ALL),
    trimmed AS (SELECT l.canonical_key, l.brand, l.model, l.size, {DEC.format("l.price")} AS media_correta FROM {{0}} l JOIN keyed k
        ON l.canonical_key IS NOT DISTINCT FROM k.canonical_key AND l.brand IS NOT DISTINCT FROM k.brand AND l.model IS NOT DISTINCT FROM k.model AND l.size IS NOT DISTINCT FROM k.size
        WHERE l.price BETWEEN k.p10 AND k.p90 GROUP BY ALL),
    summary AS (SELECT k.canonical_key, k.brand, k.model, k.size, n_listings, CASE WHEN n_prices > 0 THEN m ELSE '' END AS marketplaces, min_price, max_price, mean_price, median_price, p10, p90, media_correta, evidence_files
        FROM keyed k LEFT JOIN trimmed t ON t.canonical_key IS NOT DISTINCT FROM k.canonical_key AND t.brand IS NOT DISTINCT FROM k.brand AND t.model IS NOT DISTINCT FROM k.model AND t.size IS NOT DISTINCT FROM k.size)"""
SUM_L, SUM_G = SUMMARY.format("listings"), SUMMARY.format("gappy")


@query("canonical_summary", f"WITH {SUM_L} SELECT * FROM summary", "listings")
def _(spark, d):
    return summary.in_summary_order(summary.canonical_summary(views.listings(spark, d)))


@query("canonical_summary_gaps", f"WITH {SUM_G} SELECT * FROM summary", "gappy")
def _(spark, d):
    return summary.canonical_summary(views.gappy(spark, d))


@query("top_spread", f"WITH {SUM_L} SELECT * FROM summary WHERE n_listings >= 5 ORDER BY max_price - min_price DESC, canonical_key LIMIT 50", "listings")
def _(spark, d):
    return summary.top_spread(summary.canonical_summary(views.listings(spark, d)))


@query("fetch_groups", f"WITH {SUM_L} SELECT * FROM summary WHERE brand = 'Brand#11'", "listings")
def _(spark, d):
    return listings.fetch_groups(summary.canonical_summary(views.listings(spark, d)), brand="Brand#11")


@query("filter_listings", f"SELECT {ROW}, brand, price FROM listings WHERE lower(brand) = 'brand#12'", "listings")
def _(spark, d):
    return listings.filter_listings(views.listings(spark, d), brand="BRAND#12").select(*ROW.split(", "), "brand", "price")


@query("resolve_columns", "SELECT title, url, price, brand AS brand_raw, model AS model_raw, size AS size_raw, seller, marketplace, source_file FROM listings", "listings")
def _(spark, d):
    src = views.listings(spark, d).select(*[F.col(a).alias(b) for a, b in (("title", "Titulo"), ("url", "LINK"), ("price", "preco"), ("brand", "marca"), ("model", "modelo"), ("size", "medida"), ("seller", "vendedor"), ("source_file", "fonte"))])
    return listings.resolve_columns(src).drop("collected_at").withColumn("marketplace", F.col("marketplace"))


@query("normalize_record", "SELECT title, CASE WHEN l_partkey % 2 = 0 THEN 'SKU-' || l_partkey ELSE NULL END AS sku_norm, price, 'BRL' AS currency, seller, url FROM listings WHERE l_partkey % 2 = 0 UNION ALL SELECT title, trim(regexp_replace(upper(title), '[^0-9A-Z]+', '-', 'g'), '-'), price, 'BRL', seller, url FROM listings WHERE l_partkey % 2 <> 0", "listings")
def _(spark, d):
    src = views.listings(spark, d).select(F.lit(" ").alias("product_title"), F.col("title").alias("nome"), F.format_string("%.2f", F.col("price").cast("double")).alias("preco"), F.col("seller").alias("loja"), F.col("url").alias("href"), F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("sku "), F.col("l_partkey").cast("string"))).otherwise("").alias("sku"))
    return listings.normalize_record(src).select("title", "sku_norm", "price", "currency", "seller", "url")


REASON = "CASE WHEN url IS NULL OR trim(url) = '' THEN 'missing_url' WHEN title IS NULL OR trim(title) = '' THEN 'missing_title' WHEN price IS NULL OR price <= 0 THEN 'bad_price' WHEN marketplace IS NULL OR trim(marketplace) = '' THEN 'missing_marketplace' END"


@query("discard_reasons", f"SELECT {REASON} AS reason, count(*) AS n FROM gappy WHERE {REASON} IS NOT NULL GROUP BY 1", "gappy")
def _(spark, d):
    g = views.gappy(spark, d).withColumn("reason", listings.discard_reason()).where("reason IS NOT NULL")
    return summary.count_by(g, "reason", 12)


@query("essential_filter", f"SELECT {ROW}, title, price FROM gappy WHERE {REASON} IS NULL", "gappy")
def _(spark, d):
    return listings.essential_filter(views.gappy(spark, d)).select(*ROW.split(", "), "title", "price")


@query("has_title_or_url", f"SELECT {ROW} FROM gappy WHERE NOT ((title IS NULL OR trim(title) = '') AND (url IS NULL OR trim(url) = ''))", "gappy")
def _(spark, d):
    return listings.has_title_or_url(views.gappy(spark, d)).select(*ROW.split(", "))


@query("valid_listings", f"SELECT {ROW} FROM gappy WHERE trim(title) <> '' AND price <> 0 AND trim(url) <> ''", "gappy")
def _(spark, d):
    return views.gappy(spark, d).where(listings.is_valid_listing(F.col("title"), F.col("price"), F.col("url"))).select(*ROW.split(", "))


OFFERS = f"SELECT marketplace, title, price, url, collected_at AS captured_at, {ROW} FROM gappy"
DEDUP_OFFERS = f"""
    x AS ({OFFERS}), x0 AS (SELECT DISTINCT * FROM x),
    x1 AS (SELECT * FROM x0 QUALIFY row_number() OVER (PARTITION BY marketplace, CASE WHEN trim(url) <> '' THEN url END, CASE WHEN coalesce(trim(url), '') = '' THEN concat_ws(',', title, price, captured_at, {ROW}) END ORDER BY captured_at DESC NULLS LAST, url DESC NULLS LAST, marketplace NULLS LAST, title NULLS LAST, price NULLS LAST, url NULLS LAST, captured_at NULLS LAST, {ROW}) = 1),
    x2 AS (SELECT * FROM x1 QUALIFY row_number() OVER (PARTITION BY marketplace, title, price ORDER BY captured_at DESC NULLS LAST, url DESC NULLS LAST, {ROW}) = 1)"""


@query("dedup_offers", f"WITH {DEDUP_OFFERS} SELECT {ROW} FROM x2", "gappy")
def _(spark, d):
    x = views.gappy(spark, d).select("marketplace", "title", "price", "url", F.col("collected_at").alias("captured_at"), *ROW.split(", "))
    return dedup.dedup_offers(x).select(*ROW.split(", "))


@query("latest_snapshot", f"SELECT {ROW} FROM (SELECT marketplace, 'SKU-' || l_partkey AS sku, collected_at, {ROW}, price FROM gappy WHERE collected_at IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY marketplace, sku ORDER BY collected_at DESC, {ROW}) = 1", "gappy")
def _(spark, d):
    x = views.gappy(spark, d).select("marketplace", F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku_norm"), F.col("collected_at").alias("captured_at"), *ROW.split(", "))
    return dedup.latest_snapshot(x).select(*ROW.split(", "))


@query("latest_per_key", "SELECT l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS day, l_orderkey, l_suppkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey, l_suppkey, l_linenumber) = 1")
def _(spark, d):
    x = table(spark, d, "lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_suppkey", "l_linenumber")
    return dedup.latest_per_key(x, "l_partkey", "l_shipdate").select("l_partkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "l_orderkey", "l_suppkey", "l_linenumber")


HASURL = "(url IS NOT NULL AND trim(url) <> '')"


@query("dedup_listing", f"SELECT {ROW} FROM gappy QUALIFY row_number() OVER (PARTITION BY marketplace, seller, price, CASE WHEN {HASURL} THEN url END, CASE WHEN {HASURL} THEN collected_at END, CASE WHEN NOT {HASURL} THEN title END, CASE WHEN NOT {HASURL} THEN source_file END ORDER BY source_file, marketplace, title, price, url, brand, model, size, canonical_key, collected_at, seller, {ROW}) = 1", "gappy")
def _(spark, d):
    return dedup.dedup_listing(views.gappy(spark, d)).select(*ROW.split(", "))


@query("dedup_global", f"SELECT {ROW} FROM gappy QUALIFY row_number() OVER (PARTITION BY lower(coalesce(marketplace, '')), lower(coalesce(seller, '')), coalesce(price, -1), CASE WHEN {HASURL} THEN lower(trim(url)) END, CASE WHEN {HASURL} THEN cast(collected_at AS date) END, CASE WHEN NOT {HASURL} THEN lower(trim(coalesce(title, ''))) END ORDER BY source_file, marketplace NULLS LAST, title NULLS LAST, price NULLS LAST, url NULLS LAST, brand NULLS LAST, model NULLS LAST, size NULLS LAST, canonical_key NULLS LAST, collected_at NULLS LAST, seller NULLS LAST, {ROW}) = 1", "gappy")
def _(spark, d):
    return dedup.dedup_global(views.gappy(spark, d)).select(*ROW.split(", "))


@query("recency_check", f"SELECT {ROW} FROM gappy QUALIFY collected_at < max(collected_at) OVER (PARTITION BY marketplace, l_partkey)", "gappy")
def _(spark, d):
    x = views.gappy(spark, d).withColumnsRenamed({"collected_at": "captured_at"}).withColumn("sku_norm", F.col("l_partkey"))
    return dedup.recency_check(x).select(*ROW.split(", "))


@query("keep_first_by", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def _(spark, d):
    return dedup.keep_first_by(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], [F.col("o_orderkey")])


UPSERTED = "SELECT c_custkey, CASE WHEN o.k IS NULL THEN c_name ELSE 'orders ' || o.n END AS c_name FROM customer LEFT JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) o ON c_custkey = o.k UNION ALL SELECT -k - 1, 'orders ' || n AS c_name FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) WHERE k % 10 = 0"


def _upserts(spark, d) -> tuple[DataFrame, DataFrame]:
    counts = table(spark, d, "orders").groupBy("o_custkey").agg(F.concat(F.lit("orders "), F.count(F.lit(1)).cast("string")).alias("c_name"))
    updates = counts.select(F.col("o_custkey").alias("c_custkey"), "c_name").unionByName(counts.where("o_custkey % 10 = 0").select((-F.col("o_custkey") - 1).alias("c_custkey"), "c_name"))
    return table(spark, d, "customer").select("c_custkey", "c_name"), updates


@query("upsert_by_key", UPSERTED)
def _(spark, d):
    return dedup.upsert_by_key(*_upserts(spark, d), ["c_custkey"])


@query("upsert_table", UPSERTED)
def _(spark, d):
    """The same on a stored table, in two rounds of updates."""
    target, updates = _upserts(spark, d)
    dedup.create_upsert_table(target, path := new_path(spark, "upserted"), ["c_custkey"], buckets=64)
    for part in (updates.where("c_custkey % 3 = 0"), updates.where("c_custkey % 3 <> 0")):
        dedup.upsert_table(spark, path, part, ["c_custkey"])
    return dedup.read_upsert_table(spark, path)



@query("canonical_name", "SELECT marketplace, sku_norm, title AS product_name FROM (SELECT marketplace, l_partkey % 50 AS sku_norm, title, count(*) AS n FROM gappy WHERE title IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY marketplace, sku_norm ORDER BY n DESC, title) = 1", "gappy")
def _(spark, d):
    return listings.canonical_name(views.gappy(spark, d).withColumn("sku_norm", F.col("l_partkey") % 50))


BRANDS = tuple(f"brand#{i}" for i in range(1, 100))
SIG = """
    s AS (SELECT *, regexp_extract(lower(title), 'brand#[0-9]{1,2}') AS b,
        trim(regexp_replace(regexp_replace(replace(regexp_replace(lower(title), '\\b[0-9]{2,3}\\s*[a-z]{1,2}\\b', ' ', 'g'), regexp_extract(lower(title), 'brand#[0-9]{1,2}'), ' '), '[^0-9a-zA-Z]+', ' ', 'g'), ' +', ' ', 'g')) AS m FROM listings),
    g AS (SELECT *, 'unk' AS u FROM s),
    p AS (SELECT *, b || '|unk|' || m AS product_signature, substr(sha1(b || '|unk|' || m), 1, 16) AS product_id FROM g)"""


@query("unify_products", f"WITH {SIG} SELECT product_id, product_signature, b AS brand, min(title) AS example_title, count(DISTINCT url) AS n_offers, strftime(min(collected_at), '%Y-%m-%d') AS first_seen, strftime(max(collected_at), '%Y-%m-%d') AS last_seen FROM p GROUP BY ALL", "listings")
def _(spark, d):
    x = views.listings(spark, d).drop("brand", "model", "size").withColumnRenamed("collected_at", "captured_at").withColumn("sku_norm", F.lit(None).cast("string"))
    p = listings.unify_products(x, BRANDS)["unified_products"]
    return p.select("product_id", "product_signature", "brand", "example_title", "n_offers", F.date_format("first_seen", "yyyy-MM-dd").alias("first_seen"), F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"))


@query("unified_offers", f"WITH {SIG} SELECT product_id, marketplace, title, price, url, seller FROM p", "listings")
def _(spark, d):
    x = views.listings(spark, d).drop("brand", "model", "size").withColumnRenamed("collected_at", "captured_at").withColumn("sku_norm", F.lit(None).cast("string"))
    return listings.unify_products(x, BRANDS)["unified_offers"].select("product_id", "marketplace", "title", "price", "url", "seller")


@query("unify_stats", f"WITH {SIG} SELECT count(*) AS rows_in, count(DISTINCT product_id) AS products_out, count(*) AS offers_out, count(*) / count(DISTINCT product_id) AS avg_offers_per_product FROM p", "listings")
def _(spark, d):
    x = views.listings(spark, d).drop("brand", "model", "size").withColumnRenamed("collected_at", "captured_at").withColumn("sku_norm", F.lit(None).cast("string"))
    return listings.unify_products(x, BRANDS)["unify_stats"]


CONFIG = MatchConfig.of([b.replace("#", " ") for b in BRANDS], {"brand 11": "brand 12"}, ["standard", "small", "medium", "large", "economy", "promo"])


@query("union_all", "SELECT r_name AS name, NULL::VARCHAR AS k FROM region UNION ALL SELECT n_name, n_regionkey::VARCHAR FROM nation UNION ALL SELECT s_name, s_nationkey::VARCHAR FROM supplier")
def _(spark, d):
    t = lambda n, *c: table(spark, d, n).select(*c)
    return listings.union_all([t("region", F.col("r_name").alias("name")), t("nation", F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("k")), t("supplier", F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("k"))]).select("name", "k")


@query("search_hit_reasons", """
    WITH t AS (SELECT DISTINCT p_brand AS term, p_brand AS brand FROM part),
    h AS (SELECT brand AS term, title, price, url, seller, l_orderkey % 5 <> 0 AS available, l_orderkey, l_partkey, l_suppkey, l_linenumber FROM gappy WHERE brand <> ''),
    w AS (SELECT *, row_number() OVER (PARTITION BY term, url ORDER BY price NULLS LAST, title NULLS LAST) AS rn FROM h)
    SELECT term, CASE WHEN title IS NULL OR trim(title) = '' OR price IS NULL THEN 'parse_fail' WHEN seller IS NOT NULL AND lower(trim(seller)) IN ('supplier#000000001') THEN 'seller'
        WHEN NOT available THEN 'indisponivel' WHEN price < 100 THEN 'preco' WHEN rn > 1 THEN 'dup' ELSE 'ok' END AS reason, count(*) AS n FROM w GROUP BY ALL""", "gappy")
def _(spark, d):
    terms = table(spark, d, "part").select(F.col("p_brand").alias("term"), F.col("p_brand").alias("brand"), F.lit(None).cast("string").alias("model")).distinct()
    hits = views.gappy(spark, d).where("brand <> ''").select(F.col("brand").alias("term"), "title", "price", "url", "seller", (F.col("l_orderkey") % 5 != 0).alias("available"))
    return listings.search_hit_reason(hits, terms, blocked_sellers=("Supplier#000000001",)).groupBy("term", "reason").agg(F.count(F.lit(1)).alias("n"))


# --- summaries and reports ---


@query("brand_report", f"SELECT brand, count(canonical_key) AS n, {MEAN} AS mean_price, round(median(price), 6) AS median_price FROM gappy GROUP BY brand", "gappy")
def _(spark, d):
    return summary.brand_report(views.gappy(spark, d))


@query("dispersion_report", f"SELECT canonical_key, brand, count(price) AS n, min(price) AS min_price, {MEAN} AS mean_price, max(price) AS max_price, round(stddev_samp(price), 4) AS std_price, round(quantile_cont(price, 0.25), 6) AS q1, round(quantile_cont(price, 0.5), 6) AS median_price, round(quantile_cont(price, 0.75), 6) AS q3, round(round(stddev_samp(price), 4) / nullif({MEAN}, 0), 4) AS cv FROM listings GROUP BY 1, 2", "listings")
def _(spark, d):
    return summary.dispersion_report(views.listings(spark, d))


@query("iqr_outliers", f"""
    WITH q AS (SELECT canonical_key, round(quantile_cont(price, 0.25), 6) AS a, round(quantile_cont(price, 0.75), 6) AS b FROM listings GROUP BY 1)
    SELECT {ROW}, canonical_key, price, round(a - 1.0 * (b - a), 6) AS low, round(b + 1.0 * (b - a), 6) AS high FROM listings JOIN q USING (canonical_key) WHERE price < round(a - 1.0 * (b - a), 6) OR price > round(b + 1.0 * (b - a), 6)""", "listings")
def _(spark, d):
    return summary.iqr_outliers(views.listings(spark, d), k=1.0).select(*ROW.split(", "), "canonical_key", "price", "low", "high")


@query("price_describe", f"""
    WITH day AS (SELECT slug, d, count(price) AS n, min(price) AS min_price, round(quantile_cont(price, 0.25), 6) AS q1, round(quantile_cont(price, 0.5), 6) AS median_price, round(quantile_cont(price, 0.75), 6) AS q3, {MEAN} AS mean_price, max(price) AS max_price,
        round(stddev_samp(price), 4) AS std_price, round(avg(CASE WHEN free_shipping THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct_free_shipping FROM snapshots GROUP BY 1, 2),
    x AS (SELECT a.*, round((a.mean_price / b.mean_price - 1) * 100, 4) AS pct_change FROM day a LEFT JOIN day b ON a.slug = b.slug AND a.d = b.d + 1 QUALIFY row_number() OVER (PARTITION BY a.slug ORDER BY a.d DESC) = 1)
    SELECT * REPLACE (cast(d AS VARCHAR) AS d), coalesce(abs(pct_change) >= 5, false) AS alert FROM x""", "snapshots")
def _(spark, d):
    return summary.price_describe(views.snapshots(spark, d)).withColumn("d", F.col("d").cast("string"))


@query("aggregates_daily", "SELECT sku_key, cast(date AS VARCHAR) AS date, round(quantile_cont(price, 0.1), 6) AS comp_p10, round(quantile_cont(price, 0.5), 6) AS comp_p50, round(quantile_cont(price, 0.9), 6) AS comp_p90, min(price) AS comp_min, max(price) AS comp_max FROM offers_by_day GROUP BY 1, 2", "offers_by_day")
def _(spark, d):
    return summary.aggregates_daily(views.offers_by_day(spark, d)).withColumn("date", F.col("date").cast("string"))


@query("term_means", f"SELECT slug, {MEAN} AS mean_price FROM snapshots GROUP BY 1", "snapshots")
def _(spark, d):
    return summary.term_means(views.snapshots(spark, d))


@query("search_run_report", f"""
    WITH r AS (SELECT brand AS term, title, price, url, row_number() OVER (PARTITION BY brand ORDER BY price NULLS LAST, title, url) AS rn, l_linenumber = 1 AS promo FROM listings)
    SELECT term, count(*) AS produtos_encontrados, count(*) FILTER (promo) AS promocoes, round({MEAN}, 2) AS preco_medio, string_agg(title || '@' || url, ';' ORDER BY rn) FILTER (rn <= 20) AS produtos FROM r GROUP BY 1""", "listings")
def _(spark, d):
    hits = views.listings(spark, d).select(F.col("brand").alias("term"), "title", "price", "url", (F.col("l_linenumber") == 1).alias("promo"))
    return summary.search_run_report(hits, 20).withColumn("produtos", F.array_join(F.transform("produtos", lambda x: F.concat(x["titulo"], F.lit("@"), x["link"])), ";"))


@query("cheapest_n_mean", f"SELECT brand, {MEAN} AS mean_price, count(*) AS n FROM (SELECT brand, price FROM gappy WHERE price IS NOT NULL QUALIFY row_number() OVER (PARTITION BY brand ORDER BY price) <= 10) GROUP BY 1", "gappy")
def _(spark, d):
    return summary.cheapest_n_mean(views.gappy(spark, d), 10, "brand")


@query("top_titles", "SELECT brand, string_agg(title, ';' ORDER BY n DESC, title) AS top_title FROM (SELECT brand, title, count(*) AS n FROM gappy WHERE trim(title) <> '' GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY brand ORDER BY n DESC, title) <= 5) GROUP BY 1", "gappy")
def _(spark, d):
    return summary.top_values(views.gappy(spark, d), "brand", "title", 5).withColumn("top_title", F.array_join("top_title", ";"))


EXAMPLES = """
    r AS (SELECT *, row_number() OVER (PARTITION BY canonical_key ORDER BY price, url, title) AS rn, count(*) OVER (PARTITION BY canonical_key) AS n FROM listings WHERE price IS NOT NULL),
    e AS (SELECT * FROM r WHERE rn = 1 OR rn = n // 2 + 1 OR rn = n), u AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY canonical_key, url ORDER BY rn) = 1),
    ex AS (SELECT canonical_key, row_number() OVER (PARTITION BY canonical_key ORDER BY rn) AS example, title, price, url FROM u)"""


@query("price_examples", f"WITH {EXAMPLES} SELECT * FROM ex", "listings")
def _(spark, d):
    return summary.price_examples(views.listings(spark, d)).select("canonical_key", "example", "title", "price", "url")


BLANK = "({0} IS NULL OR trim({0}) = '')"
AVG_BLANK = "round(avg(CASE WHEN " + BLANK + " THEN 1.0 ELSE 0.0 END), 6)"


@query("missing_rate", " UNION ALL ".join(f"SELECT '{c}' AS column_name, {AVG_BLANK.format(c)} AS missing FROM gappy" for c in ("title", "url", "brand", "model", "size", "seller", "marketplace")), "gappy")
def _(spark, d):
    return summary.missing_rate(views.gappy(spark, d), ["title", "url", "brand", "model", "size", "seller", "marketplace"])


@query("fill_rate", " UNION ALL ".join(f"SELECT '{c}' AS column_name, round(1 - {AVG_BLANK.format(c)}, 6) AS filled FROM gappy" for c in ("brand", "model", "size")), "gappy")
def _(spark, d):
    return summary.fill_rate(views.gappy(spark, d), ["brand", "model", "size"])


@query("missing_by_marketplace", "SELECT marketplace, count(*) AS n_rows, " + ", ".join(f"round(avg(CASE WHEN {BLANK.format(c)} THEN 1.0 ELSE 0.0 END) * 100, 4) AS {c}_missing" for c in ("brand", "model", "size", "seller")) + " FROM gappy GROUP BY 1", "gappy")
def _(spark, d):
    return summary.missing_by_marketplace(views.gappy(spark, d))


@query("audit_issues", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM gappy WHERE " + " OR ".join(BLANK.format(c) for c in ("brand", "model", "size", "seller")), "gappy")
def _(spark, d):
    return quality.audit_df(views.gappy(spark, d), n=None)["issues"].select(*ROW.split(", "))


@query("count_by_marketplace", "SELECT marketplace, count(*) AS n FROM gappy GROUP BY 1", "gappy")
def _(spark, d):
    return summary.count_by(views.gappy(spark, d), "marketplace")


@query("snapshot_mean", f"SELECT slug, cast(d AS VARCHAR) AS d, {MEAN} AS mean_price FROM snapshots GROUP BY 1, 2", "snapshots")
def _(spark, d):
    return summary.snapshot_mean(views.snapshots(spark, d)).withColumn("d", F.col("d").cast("string"))


@query("db_summary", "SELECT count(*) AS n_rows, count(DISTINCT l_partkey) AS n_skus, strftime(min(collected_at), '%Y-%m-%d') AS first_date, strftime(max(collected_at), '%Y-%m-%d') AS last_date, count(*) / count(DISTINCT l_partkey) AS rows_per_sku FROM gappy", "gappy")
def _(spark, d):
    s = summary.db_summary(views.gappy(spark, d), "l_partkey", "collected_at")
    return s.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_date", "last_date")})


@query("regression_metrics", "SELECT round(avg(abs(l_extendedprice * (1 - l_discount) - l_extendedprice)), 4) AS mae, round(sqrt(avg((l_extendedprice * (1 - l_discount) - l_extendedprice) * (l_extendedprice * (1 - l_discount) - l_extendedprice))), 4) AS rmse FROM lineitem")
def _(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("label"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("prediction"))
    return summary.regression_metrics(x)


# --- validation sections ---

SECTIONS = {
    "critical_blanks": " UNION ALL ".join(f"SELECT '{k}' AS metric, count(*) FILTER ({c}) AS n FROM gappy" for k, c in (("rows_without_source_file", BLANK.format("source_file")), ("rows_without_canonical_key", BLANK.format("canonical_key")), ("rows_without_brand_or_model_or_size", " OR ".join(BLANK.format(c) for c in ("brand", "model", "size"))))),
    "count_by_size": "SELECT size, count(*) AS n FROM gappy GROUP BY 1 ORDER BY n DESC, size NULLS LAST LIMIT 100",
    "brand_equals_model": "SELECT brand, model, size, count(*) AS n FROM (SELECT * REPLACE (CASE WHEN l_partkey % 3 = 1 THEN upper(brand) ELSE model END AS model) FROM gappy) WHERE brand <> '' AND model <> '' AND lower(brand) = lower(model) GROUP BY 1, 2, 3 ORDER BY n DESC, brand, model LIMIT 50",
    "bad_prices": "SELECT 'negative_or_zero_prices' AS metric, count(*) FILTER (price IS NULL OR price <= 0) AS n FROM gappy",
    "backslashes": "SELECT 'n_with_backslash' AS metric, count(*) FILTER (contains(source_file, chr(92))) AS n FROM gappy",
    "key_with_many_triplets": "SELECT canonical_key, count(DISTINCT (brand, model, size)) AS distinct_triplets FROM gappy GROUP BY 1 HAVING count(DISTINCT (brand, model, size)) > 1",
    "triplet_with_many_keys": "SELECT brand, model, size, count(DISTINCT canonical_key) AS n_keys FROM gappy GROUP BY 1, 2, 3 HAVING count(DISTINCT canonical_key) > 1",
    "duplicate_urls": "SELECT marketplace, url, count(*) AS n FROM gappy GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, marketplace NULLS FIRST, url NULLS FIRST LIMIT 50",
    "multi_source_items": "SELECT brand, model, size, count(*) AS n_rows, count(DISTINCT source_file) AS n_sources, substr(string_agg(DISTINCT source_file, ' | ' ORDER BY source_file), 1, 300) AS sources_snippet FROM gappy WHERE brand <> '' AND model <> '' AND size <> '' GROUP BY 1, 2, 3 HAVING count(DISTINCT source_file) >= 2 ORDER BY n_sources DESC, n_rows DESC, brand, model, size LIMIT 100",
}


def _section(name: str):
    def run(spark, d):
        g = views.gappy(spark, d)
        if name == "brand_equals_model":  # some are
            g = g.withColumn("model", F.when(F.col("l_partkey") % 3 == 1, F.upper("brand")).otherwise(F.col("model")))
        g = g.drop(*ROW.split(", "))
        return quality.run_validations(g, summary.canonical_summary(g), sections=(name,))[name]

    return run


for _name, _sql in SECTIONS.items():
    query(f"check_{_name}", _sql, "gappy")(_section(_name))


@query("check_evidence_tails", f"WITH {SUM_L} SELECT 'asia/data/raw/' AS metric, count(*) FILTER (contains(evidence_files, 'asia/data/raw/')) AS n FROM summary UNION ALL SELECT 'africa/data/raw/', count(*) FILTER (contains(evidence_files, 'africa/data/raw/')) FROM summary", "listings")
def _(spark, d):
    return quality.evidence_from(summary.canonical_summary(views.listings(spark, d)), ("asia/data/raw/", "africa/data/raw/"))


@query("check_evidence_coverage", f"WITH {SUM_L}, top AS (SELECT * FROM summary ORDER BY n_listings DESC, canonical_key LIMIT 100), src AS (SELECT brand, model, size, string_agg(DISTINCT source_file, ',' ORDER BY source_file) AS r FROM listings GROUP BY 1, 2, 3) SELECT brand, model, size, n_listings, length(evidence_files) AS len_evidence, length(r) AS len_real, substr(evidence_files, 1, 200) AS evidence_snippet, substr(r, 1, 200) AS real_snippet FROM top JOIN src USING (brand, model, size) ORDER BY n_listings DESC, canonical_key LIMIT 50", "listings")
def _(spark, d):
    x = views.listings(spark, d)
    return quality.evidence_coverage(summary.canonical_summary(x), x)


@query("check_marketplace_divergence", f"WITH {SUM_L} SELECT brand, model, size, substr(marketplaces || ',gone', 1, 80) AS marketplaces_summary, substr(marketplaces, 1, 80) AS marketplaces_real FROM summary WHERE n_listings % 2 = 0 ORDER BY brand, model, size LIMIT 50", "listings")
def _(spark, d):
    x = views.listings(spark, d)
    stale = summary.canonical_summary(x).withColumn("marketplaces", F.when(F.col("n_listings") % 2 == 0, F.concat("marketplaces", F.lit(",gone"))).otherwise(F.col("marketplaces")))
    return quality.marketplace_divergence(stale, x)


@query("verify_snapshot", """
    WITH s AS (SELECT marketplace, l_partkey AS sku_norm, title, price, url, collected_at AS captured_at FROM gappy), w AS (SELECT *, max(captured_at) OVER (PARTITION BY marketplace, sku_norm) AS newest FROM s WHERE marketplace IS NOT NULL),
    c AS (SELECT 'required_columns' AS "check", 0 AS n_bad UNION ALL SELECT 'null_marketplace', count(*) FILTER (marketplace IS NULL) FROM s UNION ALL SELECT 'null_sku_norm', count(*) FILTER (sku_norm IS NULL) FROM s
      UNION ALL SELECT 'null_title', count(*) FILTER (title IS NULL) FROM s UNION ALL SELECT 'null_price', count(*) FILTER (price IS NULL) FROM s UNION ALL SELECT 'null_url', count(*) FILTER (url IS NULL) FROM s
      UNION ALL SELECT 'null_captured_at', count(*) FILTER (captured_at IS NULL) FROM s UNION ALL SELECT 'price_not_positive', count(*) FILTER (price <= 0) FROM s
      UNION ALL SELECT 'duplicate_keys', count(*) FROM (SELECT 1 FROM s GROUP BY marketplace, sku_norm HAVING count(*) > 1) UNION ALL SELECT 'not_latest', count(*) FILTER (captured_at < newest) FROM w)
    SELECT *, n_bad = 0 AS ok FROM c""", "gappy")
def _(spark, d):
    x = views.gappy(spark, d).select("marketplace", F.col("l_partkey").alias("sku_norm"), "title", "price", "url", F.col("collected_at").alias("captured_at"))
    return quality.verify_snapshot(x)


@query("price_sanity", f"""
    WITH {SUM_G} SELECT canonical_key, brand, model, size, concat_ws(',', CASE WHEN min_price IS NULL OR max_price IS NULL THEN 'precheck_missing_min_max' END, CASE WHEN min_price <= 0 THEN 'precheck_nonpositive_min' END,
      CASE WHEN max_price < min_price THEN 'precheck_max_less_than_min' WHEN min_price > 0 AND max_price / min_price > 3.5 THEN 'precheck_high_spread' END,
      CASE WHEN median_price <> 0 AND abs((mean_price - median_price) / median_price) > 0.25 THEN 'precheck_mean_median_divergence' END, CASE WHEN p10 > 0 AND p90 / p10 > 3.0 THEN 'precheck_wide_p10_p90' END,
      CASE WHEN n_listings < 4 THEN 'precheck_low_sample_reliability' END) AS alerts FROM summary""", "gappy")
def _(spark, d):
    s = summary.canonical_summary(views.gappy(spark, d))
    return s.select("canonical_key", "brand", "model", "size", F.array_join(quality.precheck_price_sanity(), ",").alias("alerts"))


@query("backfill", """
    WITH ev AS (SELECT url, min(brand) AS brand, min(model) AS model, min(size) AS size, min(seller) AS seller FROM listings GROUP BY 1)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(CASE WHEN trim(g.brand) <> '' THEN g.brand END, ev.brand) AS brand, coalesce(CASE WHEN trim(g.size) <> '' THEN g.size END, ev.size) AS size, coalesce(CASE WHEN trim(g.seller) <> '' THEN g.seller END, ev.seller) AS seller FROM gappy g LEFT JOIN ev ON g.url = ev.url""", "listings", "gappy")
def _(spark, d):
    ev = views.listings(spark, d).select("url", "title", "brand", "model", "size", "seller")
    return quality.backfill_from_evidence(views.gappy(spark, d), ev)["filled"].select(*ROW.split(", "), "brand", "size", "seller")


# --- audit and final set ---

AUDIT = "decisions AS (SELECT cast(doc_id AS VARCHAR) AS canonical_key, quality = 1 AS llm_ok, 0.5 + 0.5 * (doc_id % 10) / 10 AS llm_confidence, toxic = 1 AS alert FROM labels), docs AS (SELECT cast(doc_id AS VARCHAR) AS canonical_key, source AS brand, doc_id FROM documents)"


def _decisions(spark, d):
    a = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("canonical_key"), (F.col("quality") == 1).alias("llm_ok"), (0.5 + 0.5 * (F.col("doc_id") % 10) / 10).alias("llm_confidence"), F.when(F.col("toxic") == 1, F.array(F.lit("precheck"))).otherwise(F.array().cast("array<string>")).alias("precheck_alerts"))
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("canonical_key"), F.col("source").alias("brand"), "doc_id")
    return docs, a


@query("approved_listings", f"WITH {AUDIT} SELECT docs.* FROM docs JOIN decisions USING (canonical_key) WHERE llm_ok AND llm_confidence >= 0.7")
def _(spark, d):
    return audit.approved_listings(*_decisions(spark, d)).select("canonical_key", "brand", "doc_id")


@query("approved_without_alerts", f"WITH {AUDIT} SELECT docs.* FROM docs JOIN decisions USING (canonical_key) WHERE llm_ok AND llm_confidence >= 0.7 AND NOT alert")
def _(spark, d):
    return audit.approved_listings(*_decisions(spark, d), exclude_prechecks=True).select("canonical_key", "brand", "doc_id")


@query("audit_counts", f"WITH {AUDIT} SELECT count(*) FILTER (coalesce(llm_ok AND llm_confidence >= 0.7, false)) AS kept, count(*) FILTER (NOT coalesce(llm_ok AND llm_confidence >= 0.7, false)) AS dropped, count(*) AS total FROM docs LEFT JOIN decisions USING (canonical_key)")
def _(spark, d):
    return audit.audit_counts(*_decisions(spark, d))


@query("summary_of_keys", f"WITH {SUM_L} SELECT summary.* FROM summary WHERE canonical_key IN (SELECT canonical_key FROM listings WHERE price > 50000)", "listings")
def _(spark, d):
    x = views.listings(spark, d)
    return audit.summary_of_keys(summary.canonical_summary(x), x.where("price > 50000"))


@query("audit_sample", f"""
    WITH {SUM_L}, {EXAMPLES}, tt AS (SELECT canonical_key, string_agg(title, ';' ORDER BY n DESC, title) AS t FROM (SELECT canonical_key, title, count(*) AS n FROM listings GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY canonical_key ORDER BY n DESC, title) <= 5) GROUP BY 1),
    ss AS (SELECT canonical_key, string_agg(seller, ';' ORDER BY n DESC, seller) AS s FROM (SELECT canonical_key, seller, count(*) AS n FROM listings GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY canonical_key ORDER BY n DESC, seller) <= 3) GROUP BY 1),
    ee AS (SELECT canonical_key, string_agg(title, ';' ORDER BY example) AS e FROM ex GROUP BY 1)
    SELECT canonical_key, n_listings, t AS titles, s AS sellers, e AS examples FROM summary JOIN tt USING (canonical_key) JOIN ss USING (canonical_key) JOIN ee USING (canonical_key)""", "listings")
def _(spark, d):
    x = views.listings(spark, d)
    s = audit.audit_sample(summary.canonical_summary(x), x)
    return s.select("canonical_key", "n_listings", F.array_join("top_title", ";").alias("titles"), F.array_join("top_seller", ";").alias("sellers"), F.array_join(F.transform("examples", lambda e: e["title"]), ";").alias("examples"))


@query("audit_replies", "SELECT cast(event_id AS VARCHAR) AS canonical_key, CASE WHEN event_id % 7 = 0 THEN 'llm_request_failed' WHEN event_id % 5 = 0 THEN 'llm_invalid_json_response' ELSE '' END AS alerts, CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 THEN 0.0 ELSE cast(json_extract_string(props, '$.k') AS DOUBLE) END AS llm_confidence FROM events")
def _(spark, d):
    e = table(spark, d, "events")
    reply = F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string")).when(F.col("event_id") % 5 == 0, "no json").otherwise(F.concat(F.lit('{"ok": true, "alerts": [], "confidence": '), F.get_json_object("props", "$.k"), F.lit("}")))
    r = audit.parse_audit_responses(e.select(F.col("event_id").cast("string").alias("canonical_key"), reply.alias("reply")))
    return r.select("canonical_key", F.array_join("llm_alerts", ",").alias("alerts"), "llm_confidence")


# --- series ---


@query("series_features", """
    SELECT product_id, event_id, preco, round(preco - lag(preco) OVER w, 6) AS preco_diff, cast(sum(cast(preco AS decimal(20,6))) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS double) / count(preco) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS preco_ma7,
      cast(sum(cast(preco AS decimal(20,6))) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS double) / count(preco) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS preco_ma30,
      CASE WHEN abs(preco - lag(preco) OVER w) > preco * 0.3 THEN 1 ELSE 0 END AS anomaly FROM series WINDOW w AS (PARTITION BY product_id ORDER BY data_coleta, event_id)""", "series")
def _(spark, d):
    s = series.series_features(views.series(spark, d), tie=("event_id",))
    return s.select("product_id", "event_id", "preco", F.round("preco_diff", 6).alias("preco_diff"), "preco_ma7", "preco_ma30", "anomaly")


@query("price_features", """
    WITH q AS (SELECT round(quantile_cont(preco, 0.01), 6) AS lo, round(quantile_cont(preco, 0.99), 6) AS hi FROM series), c AS (SELECT product_id, event_id, data_coleta, least(greatest(preco, lo), hi) AS preco FROM series, q)
    SELECT product_id, event_id, round(preco, 6) AS preco, isodow(data_coleta) - 1 AS dia_semana, CASE WHEN isodow(data_coleta) >= 6 THEN 1 ELSE 0 END AS fim_de_semana, round(preco - lag(preco) OVER (PARTITION BY product_id ORDER BY data_coleta, preco, event_id), 4) AS preco_diff FROM c""", "series")
def _(spark, d):
    f = series.price_features(views.series(spark, d))
    return f.select("product_id", "event_id", F.round("preco", 6).alias("preco"), "dia_semana", "fim_de_semana", F.round("preco_diff", 4).alias("preco_diff"))


@query("clip_quantiles", "WITH q AS (SELECT round(quantile_cont(l_extendedprice, 0.05), 6) AS lo, round(quantile_cont(l_extendedprice, 0.95), 6) AS hi FROM lineitem) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, least(greatest(l_extendedprice, lo), hi) AS l_extendedprice FROM lineitem, q")
def _(spark, d):
    return series.clip_quantiles(table(spark, d, "lineitem").select(*ROW.split(", "), "l_extendedprice"), "l_extendedprice", 0.05, 0.95)


@query("impute_median", f"SELECT {ROW}, coalesce(price, (SELECT round(median(price), 6) FROM gappy)) AS price FROM gappy", "gappy")
def _(spark, d):
    return series.impute_median(views.gappy(spark, d).select(*ROW.split(", "), "price"), ["price"])


CHANGE = f"""
    m AS (SELECT slug, d, {MEAN} AS mean_price FROM snapshots GROUP BY 1, 2), l AS (SELECT *, lag(mean_price) OVER (PARTITION BY slug ORDER BY d) AS mean_before FROM m),
    ch AS (SELECT *, round((mean_price - mean_before) / nullif(mean_before, 0), 6) AS change FROM l)"""


@query("price_change", f"WITH {CHANGE} SELECT slug, cast(d AS VARCHAR) AS d, mean_price, mean_before, change, coalesce(abs(change) >= 0.05, false) AS flag, CASE WHEN change > 0 THEN 'up' WHEN change < 0 THEN 'down' WHEN change = 0 THEN 'same' END AS direction FROM ch", "snapshots")
def _(spark, d):
    return series.price_change(views.snapshots(spark, d)).withColumn("d", F.col("d").cast("string"))


@query("compare_with_days_before", f"WITH {CHANGE} SELECT a.slug, cast(a.d AS VARCHAR) AS d, a.mean_price, b.mean_price AS mean_before FROM m a LEFT JOIN m b ON a.slug = b.slug AND a.d = b.d + 3", "snapshots")
def _(spark, d):
    return series.compare_with_days_before(views.snapshots(spark, d), 3).withColumn("d", F.col("d").cast("string"))


@query("variation_alerts", f"WITH {CHANGE} SELECT slug, cast(d AS VARCHAR) AS d, change, CASE WHEN change > 0 THEN 'up' ELSE 'down' END AS direction FROM ch WHERE abs(change) >= 0.05", "snapshots")
def _(spark, d):
    return series.variation_alerts(views.snapshots(spark, d)).select("slug", F.col("d").cast("string").alias("d"), "change", "direction")


# --- pricing ---

DAILY = """
    daily AS (SELECT sku_key, date, round(quantile_cont(price, 0.1), 6) AS comp_p10, round(quantile_cont(price, 0.5), 6) AS comp_p50, round(quantile_cont(price, 0.9), 6) AS comp_p90, min(price) AS comp_min, max(price) AS comp_max FROM offers_by_day GROUP BY 1, 2),
    latest AS (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY sku_key ORDER BY date DESC) = 1)"""


def _training(spark, d):
    latest = dedup.rows_of_latest(views.offers_by_day(spark, d), "sku_key", "date")  # of other days no percentile is read
    return pricing.training_table(views.internal_data(spark, d), summary.aggregates_daily(latest))


@query("training_table", f"WITH {DAILY} SELECT sku_key, cost_price, sale_price, stock, comp_p10, comp_p50, comp_p90, comp_min, comp_max, sale_price AS label FROM internal_data JOIN latest USING (sku_key)", "internal_data", "offers_by_day")
def _(spark, d):
    return _training(spark, d).select("sku_key", "cost_price", "sale_price", "stock", "comp_p10", "comp_p50", "comp_p90", "comp_min", "comp_max", "label")


@query("suggest_rule", f"WITH {DAILY} SELECT sku_key, round(least(greatest(comp_p50, cost_price * 1.35, comp_p10, comp_min), comp_max), 2) AS suggested_price FROM internal_data JOIN latest USING (sku_key)", "internal_data", "offers_by_day")
def _(spark, d):
    return pricing.suggest_prices_rule(_training(spark, d)).select("sku_key", "suggested_price")


_MODELS: dict[tuple[str, str], PipelineModel] = {}


def _price_model(spark, d) -> tuple[PipelineModel, DataFrame]:
    """The trained model, one fit for both queries of a session, and the training table, whose rows are written by each."""
    key, rows = (spark.sparkContext.applicationId, d), _training(spark, d)
    if key not in _MODELS:
        _MODELS[key], _ = pricing.train_price_model(rows)
    return _MODELS[key], rows


@query("suggest_ml")
def _(spark, d):
    """Rows only: a trained model."""
    return pricing.suggest_prices_ml(*_price_model(spark, d))


@query("price_model_error")
def _(spark, d):
    model, rows = _price_model(spark, d)
    return summary.regression_metrics(model.transform(pricing.split_rows(rows)[1]))


# --- scalar functions on text, urls, numbers and products ---


def _norm_sql(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower({c})), '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9 /-]', ' ', 'g'), ' +', ' ', 'g'))"


@query("norm_text", f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_norm_sql('title')} AS t1, trim(regexp_replace(lower(coalesce(title, '')), '\\s+', ' ', 'g')) AS t3 FROM listings", "listings")
def _(spark, d):
    return views.listings(spark, d).select(*ROW.split(", "), T.norm_text(F.col("title")).alias("t1"), T.norm_txt_ws(F.col("title")).alias("t3"))


@query("norm_text_documents", "SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(lower(replace(text, 'ß', ''))), '[^a-z0-9 /-]', ' ', 'g'), ' +', ' ', 'g')) AS t FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", T.norm_text(F.col("text")).alias("t"))


@query("norm_sku", "SELECT p_partkey, trim(regexp_replace(upper(p_type), '[^0-9A-Z]+', '-', 'g'), '-') AS sku, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug, trim(regexp_replace(regexp_replace(regexp_replace(trim(p_type), '[/\\\\]', '-', 'g'), '\\s+', '-', 'g'), '[^a-zA-Z0-9_.=-]+', '-', 'g'), '-') AS part FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", T.norm_sku(F.col("p_type")).alias("sku"), T.slugify(F.col("p_name"), "_").alias("slug"), T.safe_part(F.col("p_type")).alias("part"))


@query("page_hosts", "SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS marketplace, nullif(regexp_extract(lower(url), 'https?://(?:www\\.)?([a-z0-9-]+)\\.', 1), '') AS label, regexp_replace(lower(trim(url)), '#.*$', '') AS url_norm, regexp_replace(url, '[?#].*$', '') AS link FROM pages")
def _(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", T.marketplace_from_url(u).alias("marketplace"), T.domain_label(u).alias("label"), T.url_norm(u).alias("url_norm"), T.link_clean(u).alias("link"))


@query("name_from_url", """
    WITH s AS (SELECT page_id, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS seg FROM pages),
    n AS (SELECT page_id, trim(regexp_replace(regexp_replace(seg[-1], '(?i)\\.(html?|php|aspx|jsp|json|xml|jm)$', ''), '[-_]+', ' ', 'g')) AS n FROM s)
    SELECT page_id, CASE WHEN length(n) >= 4 THEN upper(substr(n, 1, 1)) || substr(lower(n), 2) END AS name FROM n""")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", T.name_from_url(F.col("url")).alias("name"))


@query("parse_money", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice AS auto_comma, l_extendedprice AS tail_dot, floor(l_extendedprice) * 1000 AS tail_thousands, l_extendedprice AS br, l_extendedprice AS search, floor(l_extendedprice) + 0.05 AS parts FROM lineitem""")
def _(spark, d):
    p = F.col("l_extendedprice")
    whole = F.format_string("%d", F.floor(p).cast("long"))
    cents = F.format_string("%02d", F.round((p - F.floor(p)) * 100).cast("long"))
    grouped = F.regexp_replace(whole, "(?<=[0-9])(?=(?:[0-9]{3})+$)", ".")
    brl = F.concat(F.lit("R$ "), grouped, F.lit(","), cents)
    return table(spark, d, "lineitem").select(
        *ROW.split(", "), N.parse_money(brl, "auto").alias("auto_comma"), N.parse_money(F.concat(whole, F.lit("."), cents)).alias("tail_dot"), N.parse_money(F.concat(whole, F.lit(".000"))).alias("tail_thousands"),
        N.parse_money(brl, "br").alias("br"), N.parse_money(F.concat(F.lit("por "), brl, F.lit(" no pix")), "search").alias("search"), N.money_parts(whole, F.lit("5")).alias("parts"),
    )


@query("numbers", """
    SELECT event_id, round(value, 2) AS v, user_id AS n, user_id % 100 + 0.5 AS rating, CASE WHEN value > 50 THEN round((value - 50) / value * 100, 2) END AS pct, isodow(ts) - 1 AS weekday, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events""")
def _(spark, d):
    e = table(spark, d, "events")
    return e.select(
        "event_id", N.to_double_safe(F.round("value", 2).cast("string")).alias("v"), N.parse_count(F.concat(F.lit("("), F.col("user_id").cast("string"), F.lit(" reviews)"))).alias("n"),
        N.parse_rating(F.concat((F.col("user_id") % 100).cast("string"), F.lit(",5 de 5"))).alias("rating"), N.discount_pct(F.col("value"), F.lit(50.0)).alias("pct"), N.weekday_of(F.col("ts")).alias("weekday"),
        N.ts_text(N.parse_ts(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))).alias("t"),
    )


@query("promo_flag", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_tax > l_discount AS promo, CASE WHEN l_tax > l_discount THEN l_tax * 1000 END AS original FROM lineitem")
def _(spark, d):
    p = N.promo(F.array(F.col("l_tax") * 1000, F.col("l_discount") * 1000))
    return table(spark, d, "lineitem").select(*ROW.split(", "), p.alias("p")).select(*ROW.split(", "), "p.promo", "p.original")


@query("canonical_key", "SELECT p_partkey, p_brand || '|' || p_size || '|' || p_type AS canonical_key, lower(replace(p_brand, '#', ' ')) AS canon_brand, lower(p_brand) AS detected FROM part")
def _(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", E.canonical_key(F.col("p_brand"), F.col("p_size").cast("string"), F.col("p_type")).alias("canonical_key"), E.canon_brand(F.col("p_brand"), MatchConfig.of([b.replace("#", " ") for b in BRANDS])).alias("canon_brand"), E.detect_brand_substring(F.concat_ws(" ", "p_name", "p_brand"), BRANDS).alias("detected"))


@query("extract_brand_model", f"""
    SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' THEN 'brand 12' ELSE lower(replace(p_brand, '#', ' ')) END AS brand,
      coalesce(nullif(regexp_extract(' ' || {_norm_sql("p_type")} || ' ', ' (economy|standard|medium|large|promo|small) ', 1), ''), '') <> '' AS phrase FROM part""")
def _(spark, d):
    title = F.concat_ws(" ", F.col("p_type"), F.lit("x"), F.col("p_brand"))
    brand = E.extract_brand(F.lit(None), title, CONFIG, alias_first=True)
    found = E.extract_model(F.lit(None), F.col("p_type"), F.lit(None), CONFIG)
    return table(spark, d, "part").select("p_partkey", brand.alias("brand"), (found != "").alias("phrase"))


@query("product_signature", "SELECT p_partkey, lower(p_brand) || '|unk|' || lower(p_type) AS sig, substr(sha1(lower(p_brand) || '|unk|' || lower(p_type)), 1, 16) AS id, 'fb|sku ' || p_partkey AS weak FROM part")
def _(spark, d):
    none = F.lit(None).cast("string")
    sig = E.product_signature(F.lower("p_brand"), none, F.lower("p_type"), none)
    return table(spark, d, "part").select("p_partkey", sig.alias("sig"), E.product_id(sig).alias("id"), E.product_signature(none, none, F.lower("p_type"), F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string"))).alias("weak"))


@query("is_kit", "SELECT doc_id, coalesce(regexp_matches(lower(text), '(^|[^a-z0-9])(kit|kits|conjunto|jogo|par|pares|dupla|combo|fechamento|lote|unidades|caixa|pack|pacote|[24]\\s*x?\\s*pneus?|duas?\\s*pneus?|[24]\\s*unid?|4uni|k[0-9]{1,2}|([24568]|10)x|x[2468])([^a-z0-9]|$)'), false) AS kit FROM (SELECT doc_id, regexp_replace(strip_accents(replace(lower(text), 'ß', '')), '[^\\x00-\\x7F]', '', 'g') AS text FROM documents)")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", E.is_kit(F.col("text")).alias("kit"))


@query("matches_dimension", "SELECT p_partkey, true AS hit, p_size % 2 = 0 AS maybe, 'pneu ' || (100 + p_size) || ' 65 r15 ' || lower(p_brand) AS query, (100 + p_size) || '/65R15' AS size, (100 + p_size) || '-65-r15' AS folder FROM part")
def _(spark, d):
    w = (100 + F.col("p_size")).cast("string")
    title = F.concat(F.col("p_name"), F.lit(" "), w, F.lit("/65 R15 91H"))
    other = F.concat((100 + F.col("p_size") + F.col("p_size") % 2).cast("string"), F.lit("/65R15"))
    q = E.flexible_query(w, F.lit(65), F.lit(15), F.col("p_brand"), F.lit(None).cast("string"))
    return table(spark, d, "part").select("p_partkey", E.matches_dimension(title, q).alias("hit"), E.matches_dimension(other, q).alias("maybe"), q.alias("query"), E.size_canonical(q).alias("size"), E.size_folder(q).alias("folder"))


@query("search_filters", "SELECT p_partkey, (100 + p_size) || '/65R15' AS size, lower(p_brand) AS brand FROM part")
def _(spark, d):
    term = F.concat(F.lit("pneu "), (100 + F.col("p_size")).cast("string"), F.lit("-65-r15 "), F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", E.search_filters(term, BRANDS).alias("s")).select("p_partkey", "s.size", "s.brand")


@query("extract_sizes", "SELECT p_partkey, (100 + p_size) || '/55R16' AS raw, (100 + p_size) || '/55R16' AS zr, '31X10.5R15' AS off_road, '55' AS aspect, 16 AS rim FROM part")
def _(spark, d):
    w = (100 + F.col("p_size")).cast("string")
    zr = F.concat(F.col("p_name"), F.lit(" "), w, F.lit("/55ZR16"))
    return table(spark, d, "part").select(
        "p_partkey", E.extract_size(F.lit(None).cast("string"), F.concat(w, F.lit("/55 R16"))).alias("raw"), E.extract_size_multi(zr).alias("zr"), E.extract_size_multi(F.concat(F.col("p_name"), F.lit(" 31x10.5R15"))).alias("off_road"),
        E.size_parts(F.concat(w, F.lit("-55-R16")))["aspect"].alias("aspect"), E.rim(zr).alias("rim"),
    )


HEADING = "nullif(trim(regexp_extract(html, '(?is)<{0}[^>]*>(.*?)</{0}>', 1)), '')"


@query("size_forms", """
    WITH p AS (SELECT p_partkey, 100 + p_size AS w, 30 + p_partkey % 60 AS a, 10 + p_partkey % 12 AS r FROM part)
    SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN a || 'X' || (30 + w % 60) || '.5R' || r ELSE w || '/' || a || 'R' || r END AS found, w::VARCHAR AS width, a::VARCHAR AS aspect, r::VARCHAR AS rim,
      w || '/' || a || 'R' || r AS size, w || '-' || a || '-r' || r AS folder, r AS rim_number, CASE WHEN p_partkey % 2 = 0 THEN w || '/' || a || 'R' || r ELSE 'none' END AS folder_or_none FROM p""")
def _(spark, d):
    """All four forms, sizes from the SKU where the title has none, folders and rims."""
    text = lambda *c: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in c])
    key = F.col("p_partkey")
    w, a, r = 100 + F.col("p_size"), 30 + key % 60, 10 + key % 12
    form = (
        F.when(key % 4 == 0, text("tyre ", w, "/", a, "ZR", r, " x")).when(key % 4 == 1, text(w, "/", a, " ", r)).when(key % 4 == 2, text("a ", w, a, "R", r, "b"))
        .otherwise(text("4x4 ", a, "x", 30 + w % 60, ".5 r", r))
    )
    parts = E.size_parts(F.when(key % 2 == 0, text(w, " ", a, "R", r)).otherwise("no size"), text("SKU-", w, "/", a, "-R", r))
    loose = F.when(key % 2 == 0, text("x", w, " ", a, "-r", r))
    return table(spark, d, "part").select(
        "p_partkey", E.extract_size_multi(form).alias("found"), parts["width"].alias("width"), parts["aspect"].alias("aspect"), parts["rim"].alias("rim"), parts["size"].alias("size"),
        E.size_folder(text(w, "/", a, "R", r)).alias("folder"), E.rim(text("aro r ", r)).cast("bigint").alias("rim_number"), F.coalesce(E.size_canonical(loose), F.lit("none")).alias("folder_or_none"),
    )


@query("pages_extract", f"""SELECT url, trim(regexp_replace(coalesce({HEADING.format("h1")}, {HEADING.format("title")}), '<[^>]+>|\\s+', ' ', 'g')) AS title, NULL::DOUBLE AS price, NULL::DOUBLE AS previous_price,
    NULL::DOUBLE AS discount_pct, NULL::VARCHAR AS currency, false AS free_shipping, NULL::DOUBLE AS shipping_price FROM pages""")
def _(spark, d):
    """The given pages hold no price; pages made of the given tables do (extract_pages, extract_page_products)."""
    return pages.extract_listings_from_pages(table(spark, d, "pages"))
