"""Registered queries of the composite jobs (C1, C3, C4, C6, C9, C11, C20, C21) and of what only they used before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.config import MatchConfig
from offerloom.functions import attributes as E
from offerloom.functions import numbers as N
from offerloom.functions import text as T
from offerloom.operators import audit, listings, pages, quality, series, summary
from offerloom.plans import views
from offerloom.plans.catalog import BLANK, CHANGE, EXAMPLES, HASURL, MEAN, REASON, ROW, SECTIONS, SUM_G, SUM_L, SUMMARY, _norm_sql, query
from offerloom.plans.views import table
from offerloom.sources.scratch import written

# --- C1, J1: clean market items ---

CLEAN = f"""
    m0 AS (SELECT *, 'SKU-' || l_partkey AS own, 'P ' || l_partkey AS q FROM gappy),
    m1 AS (SELECT {ROW}, coalesce(nullif(trim(marketplace), ''), nullif(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '')) AS marketplace,
        coalesce(CASE WHEN trim(title) <> '' THEN title END, CASE WHEN url <> '' AND length(l_suppkey::VARCHAR) >= 4 THEN l_suppkey::VARCHAR END, CASE WHEN length(q) >= 4 THEN q END) AS title,
        CASE WHEN l_partkey % 41 <> 0 THEN own END AS sku, price, url, collected_at AS captured_at FROM m0),
    m2 AS (SELECT * REPLACE (coalesce(sku, trim(regexp_replace(upper(title), '[^0-9A-Z]+', '-', 'g'), '-')) AS sku) FROM m1),
    m3 AS (SELECT * FROM m2 WHERE {REASON} IS NULL),
    m4 AS (SELECT * FROM m3 QUALIFY row_number() OVER (PARTITION BY marketplace, url ORDER BY captured_at DESC NULLS LAST, url DESC, marketplace, title, price, captured_at) = 1),
    m5 AS (SELECT * FROM m4 QUALIFY row_number() OVER (PARTITION BY marketplace, title, price ORDER BY captured_at DESC NULLS LAST, url DESC, sku) = 1),
    names AS (SELECT marketplace AS m, sku AS s, title AS product_name FROM (SELECT marketplace, sku, title, count(*) AS n FROM m5 GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY marketplace, sku ORDER BY n DESC, title) = 1),
    clean AS (SELECT m5.*, product_name FROM m5 LEFT JOIN names ON marketplace IS NOT DISTINCT FROM m AND sku IS NOT DISTINCT FROM s)"""


def _clean(spark, d, name: str) -> DataFrame:
    """All rows, in the columns that the queries show or that fill these."""
    items = views.market_items(spark, d).select("marketplace", "query", "title", "sku_norm", "price", "url", "captured_at")
    return listings.clean_market_items(items, (name,))[name]


@query("clean_market_items", f"WITH {CLEAN} SELECT marketplace, title, sku AS sku_norm, price, url, strftime(captured_at, '%Y-%m-%d %H:%M:%S') AS captured_at, cast(cast(captured_at AS date) AS VARCHAR) AS captured_date, product_name FROM clean", "gappy")
def _(spark, d):
    return _clean(spark, d, "market_items_clean").select("marketplace", "title", "sku_norm", "price", "url", F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss").alias("captured_at"), F.col("captured_date").cast("string").alias("captured_date"), "product_name")


@query("unifier_input", f"WITH {CLEAN} SELECT marketplace, sku AS sku_norm, strftime(max(captured_at), '%Y-%m-%d') AS captured_at FROM clean WHERE sku IS NOT NULL AND captured_at IS NOT NULL GROUP BY 1, 2", "gappy")
def _(spark, d):
    return _clean(spark, d, "unifier_input").select("marketplace", "sku_norm", F.date_format("captured_at", "yyyy-MM-dd").alias("captured_at"))


@query("products_dim", f"WITH {CLEAN} SELECT DISTINCT marketplace, sku AS sku_norm, product_name FROM clean", "gappy")
def _(spark, d):
    return _clean(spark, d, "products_dim")


@query("market_item_discards", f"WITH {CLEAN} SELECT {REASON} AS reason, count(*) AS n FROM m2 WHERE {REASON} IS NOT NULL GROUP BY 1", "gappy")
def _(spark, d):
    return _clean(spark, d, "discards").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("with_canonical_name", f"WITH n AS (SELECT marketplace AS m, l_partkey % 50 AS s, title AS product_name FROM (SELECT marketplace, l_partkey, title, count(*) OVER (PARTITION BY marketplace, l_partkey % 50, title) AS k FROM gappy WHERE title IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY marketplace, l_partkey % 50 ORDER BY k DESC, title) = 1) SELECT {ROW}, product_name FROM gappy LEFT JOIN n ON marketplace IS NOT DISTINCT FROM m AND l_partkey % 50 = s", "gappy")
def _(spark, d):
    return listings.with_canonical_name(views.gappy(spark, d).withColumn("sku_norm", F.col("l_partkey") % 50)).select(*ROW.split(", "), "product_name")


# --- C3, C4: canonical listings ---

PHRASES = ("standard", "economy", "medium", "large", "promo", "small")
BUILD = MatchConfig.of([f"brand {i}" for i in range(1, 100)], {"brand 11": "brand 12"}, PHRASES)
#: The words of a title that a phrase was looked for in: the longest phrase first, equal lengths by name.
IN_TITLE = "CASE " + " ".join(f"WHEN contains(' ' || nt || ' ', ' {p} ') THEN '{p}'" for p in sorted(PHRASES, key=lambda p: (-len(p), p))) + " ELSE '' END"
CANONICAL = f"""
    c0 AS (SELECT *, {_norm_sql("title")} AS nt, lower(replace(brand, '#', ' ')) AS nb FROM listings),
    c1 AS (SELECT marketplace, title, price, url, CASE WHEN nb = 'brand 11' THEN 'brand 12' ELSE nb END AS brand,
        CASE WHEN l_partkey % 2 = 0 THEN lower(model) ELSE {IN_TITLE} END AS model, (100 + size::INT) || '/55R16' AS size, collected_at, seller, source_file FROM c0),
    c2 AS (SELECT marketplace, title, price, url, brand, model, size, trim(brand || '|' || size || '|' || model, '|') AS canonical_key, collected_at, seller, source_file FROM c1),
    c3 AS (SELECT * FROM c2 QUALIFY row_number() OVER (PARTITION BY marketplace, seller, price, url, collected_at ORDER BY source_file, title, brand, model, size) = 1),
    c4 AS (SELECT * FROM c3 QUALIFY row_number() OVER (PARTITION BY lower(marketplace), lower(seller), price, lower(url), cast(collected_at AS date) ORDER BY source_file, marketplace, title, price, url, brand, model, size, canonical_key, collected_at, seller) = 1)"""
OUT = "marketplace, title, price, url, brand, model, size, canonical_key, strftime(collected_at, '%Y-%m-%d %H:%M:%S') AS collected_at, seller, source_file"


def _sized(spark, d) -> DataFrame:
    """Listings whose size is a tyre size in the size column or, for odd suppliers, in the title; every other one has no model."""
    text = F.concat((100 + F.col("size").cast("int")).cast("string"), F.when(F.col("l_suppkey") % 2 == 0, "/55 R16").otherwise("-55 r 16"))
    return views.listings(spark, d).withColumns({"size": text, "model": F.when(F.col("l_partkey") % 2 == 0, F.col("model"))})


def _built(c: DataFrame) -> DataFrame:
    return c.select("marketplace", "title", "price", "url", "brand", "model", "size", "canonical_key", N.ts_text(F.col("collected_at")).alias("collected_at"), "seller", "source_file")


@query("build_canonical", f"WITH {CANONICAL} SELECT {OUT} FROM c3", "listings")
def _(spark, d):
    return _built(listings.build_canonical(listings.resolve_columns(_sized(spark, d).drop("canonical_key")), BUILD))


def _unified(spark, d) -> dict[str, DataFrame]:
    """Two frames with different column names and price texts."""
    x = _sized(spark, d).drop("canonical_key")
    brl = F.concat(F.lit("R$ "), F.replace(F.format_string("%.2f", "price"), F.lit("."), F.lit(",")))
    one = x.where("marketplace < 'b'").select(F.col("title").alias("Titulo"), F.col("url").alias("link"), brl.alias("preco"), F.col("seller").alias("loja"), F.col("collected_at").alias("data_coleta"), F.col("source_file").alias("arquivo"), F.col("brand").alias("marca"), F.col("model").alias("modelo"), F.col("size").alias("medida"), F.col("marketplace"))
    return listings.unify_marketplaces([one, x.where("marketplace >= 'b'")], BUILD)


@query("unified_listings", f"WITH {CANONICAL} SELECT {OUT} FROM c4", "listings")
def _(spark, d):
    return _built(_unified(spark, d)["unified_listings"])


@query("unify_marketplaces", f"WITH {CANONICAL}, {SUMMARY.format('c4')} SELECT * FROM summary", "listings")
def _(spark, d):
    return _unified(spark, d)["canonical_summary"]


# --- C9, C11: audit documents and the final set ---

SAMPLES = f"""{SUM_L}, {EXAMPLES}, tt AS (SELECT canonical_key, string_agg(title, '","' ORDER BY n DESC, title) AS t FROM (SELECT canonical_key, title, count(*) AS n FROM listings GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY canonical_key ORDER BY n DESC, title) <= 5) GROUP BY 1),
    ee AS (SELECT canonical_key, string_agg(title, ';' ORDER BY example) AS e FROM ex GROUP BY 1)"""


@query("audit_requests", f"""WITH {SAMPLES} SELECT canonical_key, brand, n_listings, min_price, media_correta, '["' || t || '"]' AS titles, e AS examples,
    concat_ws(',', CASE WHEN min_price > 0 AND max_price / min_price > 3.5 THEN 'precheck_high_spread' END, CASE WHEN abs((mean_price - median_price) / median_price) > 0.25 THEN 'precheck_mean_median_divergence' END,
      CASE WHEN p10 > 0 AND p90 / p10 > 3.0 THEN 'precheck_wide_p10_p90' END, CASE WHEN n_listings < 4 THEN 'precheck_low_sample_reliability' END) AS alerts
    FROM summary JOIN tt USING (canonical_key) JOIN ee USING (canonical_key)""", "listings")
def _(spark, d):
    """The fields of the documents, read back from their JSON text."""
    x = views.listings(spark, d)
    r = audit.audit_requests(audit.audit_sample(summary.canonical_summary(x), x))
    g = lambda p: F.get_json_object("request", f"$.{p}")
    examples = F.array_join(F.transform(F.from_json(g("examples"), "array<struct<title:string>>"), lambda e: e["title"]), ";")
    return r.select("canonical_key", g("brand").alias("brand"), g("n_listings").cast("long").alias("n_listings"), g("prices.min").cast("double").alias("min_price"), g("prices.media_correta").cast("double").alias("media_correta"), g("titles_sample").alias("titles"), examples.alias("examples"), F.array_join("precheck_alerts", ",").alias("alerts"))


FINAL = f"{SUM_G}, decided AS (SELECT canonical_key, coalesce(n_listings % 3 <> 0, false) AND 0.5 + (n_listings % 10) / 10 >= 0.7 AS ok FROM summary), final AS (SELECT g.* FROM gappy g JOIN decided USING (canonical_key) WHERE ok)"


def _final(spark, d, name: str) -> DataFrame:
    """The listings are written without what no report shows, and so is their summary, as more than one step reads them."""
    g = views.gappy(spark, d).withColumn("canonical_key", F.concat_ws("|", "canonical_key", "brand", "model", "size"))
    g = written(g.drop("title", "url", "collected_at", "seller"), "keyed")
    s = written(summary.canonical_summary(g), "groups")
    decisions = s.select("canonical_key", (F.col("n_listings") % 3 != 0).alias("llm_ok"), (0.5 + (F.col("n_listings") % 10) / 10).alias("llm_confidence"), F.array().cast("array<string>").alias("precheck_alerts"))
    return audit.generate_final(g, s, decisions, sections=(name,))[name]


KEYED = FINAL.replace("FROM gappy", "FROM keyed_rows").replace("JOIN gappy", "JOIN keyed_rows").replace(" l JOIN keyed k", " l JOIN keyed k")
KEYED = "keyed_rows AS (SELECT * REPLACE (concat_ws('|', canonical_key, brand, model, size) AS canonical_key) FROM gappy), " + KEYED


@query("final_listings", f"WITH {KEYED} SELECT {ROW}, canonical_key, price FROM final", "gappy")
def _(spark, d):
    return _final(spark, d, "unified_listings_final").select(*ROW.split(", "), "canonical_key", "price")


@query("final_summary", f"WITH {KEYED} SELECT s.* FROM summary s WHERE canonical_key IN (SELECT canonical_key FROM final)", "gappy")
def _(spark, d):
    return _final(spark, d, "canonical_summary_final")


@query("final_counts", f"WITH {KEYED} SELECT count(*) FILTER (ok) AS kept, count(*) FILTER (NOT ok) AS dropped, count(*) AS total FROM keyed_rows JOIN decided USING (canonical_key)", "gappy")
def _(spark, d):
    return _final(spark, d, "counts")


@query("final_brand_report", f"WITH {KEYED} SELECT brand, count(*) AS n, {MEAN} AS mean_price, round(median(price), 6) AS median_price FROM final GROUP BY 1", "gappy")
def _(spark, d):
    return _final(spark, d, "brand_report")


@query("final_outliers", f"""WITH {KEYED}, q AS (SELECT canonical_key, round(quantile_cont(price, 0.25), 6) AS a, round(quantile_cont(price, 0.75), 6) AS b FROM final GROUP BY 1)
    SELECT {ROW}, price FROM final JOIN q USING (canonical_key) WHERE price < round(a - 1.5 * (b - a), 6) OR price > round(b + 1.5 * (b - a), 6)""", "gappy")
def _(spark, d):
    return _final(spark, d, "outliers").select(*ROW.split(", "), "price")


# --- C6, J8: backfill from JSON evidence ---


@query("backfill_suggestions", f"""WITH ev AS (SELECT url, min(brand) AS b, min(seller) AS s FROM listings GROUP BY 1)
    SELECT {ROW}, CASE WHEN {BLANK.format("brand")} THEN lower(replace(b, '#', ' ')) END AS brand, CASE WHEN {BLANK.format("seller")} THEN s END AS seller
    FROM gappy JOIN ev USING (url) WHERE {BLANK.format("brand")} OR {BLANK.format("seller")}""", "listings", "gappy")
def _(spark, d):
    """Sellers come from a JSON field, brands from the title inside the JSON text."""
    ev = views.listings(spark, d).groupBy("url").agg(F.min("brand").alias("b"), F.min("seller").alias("s"))
    ev = ev.select("url", F.to_json(F.struct(F.col("s").alias("loja"), F.concat(F.lit("item "), F.col("b")).alias("titulo"))).alias("payload"))
    config = MatchConfig.of([f"brand {i}" for i in range(1, 100)])
    g = views.gappy(spark, d).withColumns({"model": F.lit("m"), "size": F.lit("s")})
    out = quality.backfill_from_evidence(g, ev, "payload", config)["suggestions_by_row"]
    return out.select(*ROW.split(", "), "brand", "seller")


# --- C13, J10, L3 ---


def _validation(spark, d, name: str) -> DataFrame:
    g = views.gappy(spark, d).drop(*ROW.split(", "))
    return quality.run_validations(g, summary.canonical_summary(g), sections=(name,))[name]


@query("check_evidence_samples", f"WITH {SUM_G} SELECT brand, model, size, n_listings, marketplaces, substr(evidence_files, 1, 200) AS evidence_snippet FROM summary WHERE trim(evidence_files) <> '' ORDER BY n_listings DESC, canonical_key NULLS FIRST LIMIT 50", "gappy")
def _(spark, d):
    return _validation(spark, d, "evidence_samples")


@query("check_raw_listings", "SELECT canonical_key, url, strftime(collected_at, '%Y-%m-%d') AS collected_at, seller FROM gappy ORDER BY canonical_key NULLS FIRST, url NULLS FIRST, collected_at NULLS FIRST, seller NULLS FIRST LIMIT 10", "gappy")
def _(spark, d):
    return _validation(spark, d, "raw_listings").select("canonical_key", "url", F.date_format("collected_at", "yyyy-MM-dd").alias("collected_at"), "seller")


@query("validation_sections", f"""WITH {SUM_G}, {", ".join(f"x_{k} AS ({v})" for k, v in SECTIONS.items())}
    {" UNION ALL ".join(f"SELECT '{k}' AS section, count(*) AS n FROM x_{k}" for k in SECTIONS if k != "brand_equals_model")}
    UNION ALL SELECT 'raw_summary', least(10, count(*)) FROM summary UNION ALL SELECT 'raw_listings', least(10, count(*)) FROM gappy UNION ALL SELECT 'count_by_marketplace', count(*) FROM (SELECT marketplace FROM gappy GROUP BY 1)""", "gappy")
def _(spark, d):
    """Rows of each section, all of them from one pre-aggregate of the listings."""
    g = views.gappy(spark, d).drop(*ROW.split(", "))
    made = quality.run_validations(g, summary.canonical_summary(g))
    names = [*(k for k in SECTIONS if k != "brand_equals_model"), "raw_summary", "raw_listings", "count_by_marketplace"]
    return listings.union_all([made[k].agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("section"), "n") for k in names])


@query("check_raw_summary", f"WITH {SUM_G} SELECT canonical_key FROM summary ORDER BY canonical_key NULLS FIRST LIMIT 10", "gappy")
def _(spark, d):
    return _validation(spark, d, "raw_summary").select("canonical_key")


@query("check_unfilled_columns", "WITH filled AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (NOT {BLANK.format(c)}) AS n FROM gappy" for c in ("marketplace", "title", "price::VARCHAR", "url", "brand", "model", "size", "collected_at::VARCHAR", "source_file")).replace("'price::VARCHAR'", "'price'").replace("'collected_at::VARCHAR'", "'collected_at'") + ") SELECT * FROM (VALUES " + ", ".join(f"('{c}')" for c in quality.LISTING_COLUMNS) + ") t(column_name) EXCEPT SELECT column_name FROM filled WHERE n > 0", "gappy")
def _(spark, d):
    """canonical_key isn't there, seller holds nothing."""
    g = views.gappy(spark, d).drop("canonical_key").withColumn("seller", F.when(F.col("price") > 0, " "))
    return quality.unfilled_columns(g, quality.LISTING_COLUMNS)


@query("issue_sample", "SELECT marketplace, url, title FROM gappy WHERE " + " OR ".join(BLANK.format(c) for c in ("brand", "model", "size", "seller")) + " ORDER BY marketplace NULLS FIRST, url NULLS FIRST, title NULLS FIRST LIMIT 5000", "gappy")
def _(spark, d):
    return quality.audit_df(views.gappy(spark, d))["issues"].select("marketplace", "url", "title")


# --- functions ---


@query("canon_model", f"""SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'special offer' ELSE {_norm_sql("p_type")} END AS model, trim({_norm_sql("p_name")}) || ' z' AS stripped FROM part""")
def _(spark, d):
    p = table(spark, d, "part")
    noisy = F.concat(F.lit("XL "), F.col("p_name"), F.lit(" 91V R16 z TL"))
    return p.select("p_partkey", E.canon_model(F.col("p_type"), MatchConfig.of(model_aliases={"promo": "special offer"})).alias("model"), E.canon_model(noisy, strip_codes=True).alias("stripped"))


@query("extract_model", f"""SELECT p_partkey, lower(p_type) AS given, '' AS is_brand, {IN_TITLE} AS phrase, lower(p_name) AS after_brand FROM (SELECT *, {_norm_sql("p_name || ' ' || p_type")} AS nt FROM part)""")
def _(spark, d):
    """The given model, a model that is the brand, the longest phrase in the title, and the words between brand and size."""
    p, none, brand = table(spark, d, "part"), F.lit(None).cast("string"), F.lower(F.replace("p_brand", F.lit("#"), F.lit(" ")))
    no_phrases = MatchConfig.of([f"brand {i}" for i in range(1, 100)])
    title = F.concat(F.col("p_brand"), F.lit(" pneu "), F.col("p_name"), F.lit(" 205/55R16 extra"))
    return p.select("p_partkey", E.extract_model(F.col("p_type"), F.lit("x"), brand, BUILD).alias("given"), E.extract_model(F.col("p_brand"), F.lit("x"), brand, BUILD).alias("is_brand"), E.extract_model(none, F.concat_ws(" ", "p_name", "p_type"), none, BUILD).alias("phrase"), E.extract_model(none, title, brand, no_phrases).alias("after_brand"))


@query("search_filter_models", f"SELECT p_partkey, (100 + p_size) || '/65R15' AS size, lower(p_brand) AS brand, nullif({IN_TITLE}, '') AS model FROM (SELECT *, {_norm_sql("p_type || ' ' || p_name")} AS nt FROM part)")
def _(spark, d):
    """What a search term asks for, the model phrase included."""
    term = F.concat(F.lit("pneu "), (100 + F.col("p_size")).cast("string"), F.lit("-65-r15 "), "p_brand", F.lit(" "), "p_type", F.lit(" "), "p_name")
    return table(spark, d, "part").select("p_partkey", E.search_filters(term, tuple(f"brand#{i}" for i in range(1, 100)), BUILD).alias("s")).select("p_partkey", "s.*")


@query("free_shipping", "SELECT p_partkey, p_size % 3 = 0 AS free, CASE p_size % 3 WHEN 0 THEN 0.0 WHEN 1 THEN p_size + 0.9 END AS cost, p_size % 2 = 0 AS ships_free FROM part")
def _(spark, d):
    k = F.col("p_size") % 3
    text = F.when(k == 0, "Envio GRÁTIS hoje").when(k == 1, F.concat(F.lit("Frete: R$ "), F.col("p_size").cast("string"), F.lit(",90"))).otherwise("retira na loja 12")
    p = table(spark, d, "part").select("p_partkey", N.free_shipping(text).alias("s"), N.ships_free(F.lit(True), F.when(F.col("p_size") % 2 == 0, 0.0).otherwise(5.0)).alias("ships_free"))
    return p.select("p_partkey", "s.free", "s.cost", "ships_free")


@query("url_names", "SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) AS query_name, 'https://www.shop.com/' || p_partkey || '?a=b c' AS target, 'B0' || lpad(p_partkey::VARCHAR, 8, '0') AS asin, 'pneu ' || p_partkey || '/55.5-e_' AS dots FROM part")
def _(spark, d):
    p, key = table(spark, d, "part"), F.col("p_partkey").cast("string")
    query_ = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_20250102_101112.json"))
    click = F.concat(F.lit("https://click1.mercadolivre.com.br/x?k=1&url=https%3A%2F%2Fwww.shop.com%2F"), key, F.lit("%3Fa%3Db+c"))
    link = F.concat(F.lit("https://shop.com/x/dp/B0"), F.lpad(key, 8, "0"), F.lit("/ref=1"))
    return p.select("p_partkey", T.name_from_query(query_).alias("query_name"), T.unwrap_click_url(click).alias("target"), T.asin(link).alias("asin"), T.norm_text_keep_dots(F.concat(F.lit("  PNEU (#)"), key, F.lit("/55.5-É_*!"))).alias("dots"))


@query("norm_text_keep_dots", f"SELECT {ROW}, lower(trim(regexp_replace(regexp_replace(coalesce(title, '') || ' 4.5/6-e_' || l_partkey, '[^\\p{{L}}\\p{{N}}_\\s/.-]', ' ', 'g'), '\\s+', ' ', 'g'))) AS t FROM gappy", "gappy")
def _(spark, d):
    t = F.concat(F.coalesce("title", F.lit("")), F.lit(" 4.5/6-é_"), F.col("l_partkey").cast("string"))
    return views.gappy(spark, d).select(*ROW.split(", "), T.norm_text_keep_dots(t).alias("t"))


@query("counts_and_slugs", "SELECT p_partkey, p_size AS stock, 0 AS no_stock, p_partkey AS rating_count, substr(replace(p_name, ' ', '-'), 1, 5) AS cut, 'none' AS empty FROM part")
def _(spark, d):
    p = table(spark, d, "part")
    text = lambda c, a, b: F.concat(F.lit(a), F.col(c).cast("string"), F.lit(b))
    cut = F.regexp_replace(T.slugify(F.col("p_name"), max_len=5), "^-+|-+$", "")
    return p.select("p_partkey", N.parse_stock(text("p_size", "restam ", " unidades")).cast("int").alias("stock"), N.parse_stock(F.lit("esgotado")).cast("int").alias("no_stock"), N.parse_rating_count(text("p_partkey", "4,7 (", ")")).alias("rating_count"), F.rpad(cut, 5, "-").alias("cut"), T.slugify(F.lit("!?"), default="none").alias("empty"))


@query("title_flags", """SELECT doc_id, coalesce(regexp_matches(text, '(?i)(^|[^a-z0-9])(kit|jogo|par|dupla|conjunto|combo|lote|cx|caixa|c/|pack|pckt|pacote|([24568]|10)x|x[2468])([^a-z0-9]|$)'), false) AS kit,
    coalesce(regexp_matches(text, '(?i)(^|[^\\p{L}\\p{N}_])[0-9]{1,2}\\s?(un|uni|unid|unidades|pçs|pcs|peças)([^\\p{L}\\p{N}_]|$)'), false) AS units, coalesce(regexp_matches(text, '(?i)(^|[^\\p{L}\\p{N}_])(aro|rin)\\s?[0-9]{2}([^\\p{L}\\p{N}_]|$)'), false) AS rim
    FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN text || ' 12 peças' WHEN 1 THEN 'Aro 15 ' || text ELSE text END AS text FROM documents)""")
def _(spark, d):
    t = table(spark, d, "documents")
    text = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" 12 peças"))).when(F.col("doc_id") % 5 == 1, F.concat(F.lit("Aro 15 "), "text")).otherwise(F.col("text"))
    flags = quality.precheck_title_flags(F.array(text))
    has = lambda c: F.coalesce(F.array_contains(flags, c), F.lit(False))
    return t.select("doc_id", has("precheck_title_maybe_kit_or_multiunit").alias("kit"), has("precheck_title_explicit_multiunit").alias("units"), has("precheck_title_extra_rim_dimension").alias("rim"))


@query("search_reasons_all", """
    WITH h AS (SELECT brand, CASE l_linenumber WHEN 2 THEN 'Kit ' || t || ' 205/55R16' WHEN 3 THEN t WHEN 4 THEN 'other 205/55R16' ELSE t || ' 205/55R16' END AS title, model, price, url, seller, l_orderkey % 5 <> 0 AS available, l_linenumber
        FROM (SELECT *, 'tyre ' || brand || CASE WHEN l_partkey % 3 = 0 THEN ' small' ELSE '' END AS t FROM gappy WHERE brand <> '')),
    w AS (SELECT *, row_number() OVER (PARTITION BY brand, url ORDER BY price NULLS LAST, title) AS rn FROM h)
    SELECT brand AS term, CASE WHEN price IS NULL THEN 'parse_fail' WHEN l_linenumber = 3 THEN 'sem_dim' WHEN l_linenumber = 2 THEN 'kit' WHEN l_linenumber = 4 THEN 'marca_diff' WHEN brand IN ('Brand#12', 'Brand#21') AND NOT contains(title, 'small') THEN 'modelo_diff'
        WHEN lower(trim(seller)) = 'supplier#000000001' THEN 'seller' WHEN NOT available THEN 'indisponivel' WHEN price < 100 THEN 'preco' WHEN rn > 1 THEN 'dup' ELSE 'ok' END AS reason, count(*) AS n FROM w GROUP BY ALL""", "gappy")
def _(spark, d):
    """Every reason: hits without the size, kits, other brands and models among them."""
    g = views.gappy(spark, d).where("brand <> ''")
    t = F.concat(F.lit("tyre "), F.col("brand"), F.when(F.col("l_partkey") % 3 == 0, " small").otherwise(""))
    size = F.lit(" 205/55R16")
    title = F.when(F.col("l_linenumber") == 2, F.concat(F.lit("Kit "), t, size)).when(F.col("l_linenumber") == 3, t).when(F.col("l_linenumber") == 4, F.concat(F.lit("other"), size)).otherwise(F.concat(t, size))
    term = F.concat(F.lit("205 55 16 "), F.col("brand"))
    hits = g.select(term.alias("term"), title.alias("title"), "price", "url", "seller", (F.col("l_orderkey") % 5 != 0).alias("available"))
    terms = table(spark, d, "part").select(F.concat(F.lit("205 55 16 "), "p_brand").alias("term"), F.col("p_brand").alias("brand"), F.when(F.col("p_brand").isin("Brand#12", "Brand#21"), "small").alias("model")).distinct()
    out = listings.search_hit_reason(hits, terms, blocked_sellers=("Supplier#000000001",))
    return out.groupBy(F.substring("term", 11, 100).alias("term"), "reason").agg(F.count(F.lit(1)).alias("n"))


@query("alert_texts", f"WITH {CHANGE} SELECT slug, 'Price alert: ' || slug || ' ' || CASE WHEN change > 0 THEN 'up' ELSE 'down' END || ' ' || round(change * 100, 1) || '%' AS subject, slug || ' on ' || strftime(d, '%Y-%m-%d') || ': mean price changed by ' || round(change * 100, 1) || '%' AS body FROM ch WHERE abs(change) >= 0.05", "snapshots")
def _(spark, d):
    return series.variation_alerts(views.snapshots(spark, d)).select("slug", "subject", "body")


# --- C20, C21: pages made of parts ---

PAGES = """
    SELECT p_partkey, 'https://shop.com/' || p_partkey AS url, CASE p_partkey % 3
      WHEN 0 THEN '<html><script type="application/ld+json">{"name": "' || p_name || '", "offers": {"price": "' || cast(p_retailprice AS VARCHAR) || '", "priceCurrency": "BRL"}}</script><del>R$ ' || (p_size + 2000) || ',00</del> Frete gratis</html>'
      WHEN 1 THEN '<title>' || p_name || '</title><meta itemprop="price" content="' || (p_size + 100) || ',50"><del>9</del><p>Frete R$ 12,90</p>'
      ELSE '<h1>' || p_name || '</h1><p>por R$ 1.' || (p_size + 100) || ',25 no pix</p>' END AS html FROM part"""


def _parts(spark, d) -> DataFrame:
    """Rows of part, spread over the tasks: a page is far more work than its row, and a small file is one task."""
    return table(spark, d, "part").repartition(4 * spark.sparkContext.defaultParallelism, "p_partkey")


def _pages(spark, d) -> DataFrame:
    p, size = _parts(spark, d), lambda n: (F.col("p_size") + n).cast("string")
    cat = lambda *c: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in c])
    k, name = F.col("p_partkey") % 3, F.col("p_name")
    html = (
        F.when(k == 0, cat('<html><script type="application/ld+json">{"name": "', name, '", "offers": {"price": "', F.col("p_retailprice").cast("string"), '", "priceCurrency": "BRL"}}</script><del>R$ ', size(2000), ",00</del> Frete gratis</html>"))
        .when(k == 1, cat("<title>", name, '</title><meta itemprop="price" content="', size(100), ',50"><del>9</del><p>Frete R$ 12,90</p>'))
        .otherwise(cat("<h1>", name, "</h1><p>por R$ 1.", size(100), ",25 no pix</p>"))
    )
    return p.select("p_partkey", cat("https://shop.com/", F.col("p_partkey").cast("string")).alias("url"), html.alias("html"))


@query("extract_pages", "SELECT 'https://shop.com/' || p_partkey AS url, p_name AS title, CASE p_partkey % 3 WHEN 0 THEN p_retailprice WHEN 1 THEN p_size + 100.5 ELSE p_size + 1100.25 END AS price, CASE WHEN p_partkey % 3 = 0 AND p_size + 2000 > p_retailprice THEN p_size + 2000.0 END AS previous_price, CASE WHEN p_partkey % 3 = 0 THEN 'BRL' END AS currency, p_partkey % 3 = 0 AS free_shipping, CASE p_partkey % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 12.9 END AS shipping_price FROM part")
def _(spark, d):
    return pages.extract_listings_from_pages(_pages(spark, d)).drop("discount_pct")


@query("extract_page_products", """
    WITH n AS (SELECT *, unnest(range(1 + p_partkey % 3)) AS k, 1 + p_partkey % 3 AS of FROM part)
    SELECT 'https://shop.com/' || p_partkey AS url, p_name || ' ' || k AS title, CASE WHEN k = 1 THEN p_size + 1.5 ELSE p_retailprice + k END AS price,
      CASE WHEN k = 2 THEN p_retailprice + 1000 END AS previous_price, CASE WHEN k = 1 THEN 'EUR' ELSE 'BRL' END AS currency FROM n""")
def _(spark, d):
    """Pages with one to three products: alone, in a graph, and in an item list beside other nodes; single offers, lists of offers, offers of a range."""
    p = _parts(spark, d).withColumn("price_", F.col("p_retailprice").cast("double"))
    name = lambda k: F.concat(F.col("p_name"), F.lit(f" {k}"))
    price = lambda k: F.format_string("%.2f", F.col("price_") + k)
    node = [
        F.to_json(F.struct(F.lit("Product").alias("@type"), name(0).alias("name"), F.struct(F.lit("Offer").alias("@type"), price(0).alias("price"), F.lit("BRL").alias("priceCurrency")).alias("offers"))),
        F.to_json(F.struct(F.array(F.lit("Thing"), F.lit("Product")).alias("@type"), name(1).alias("name"), F.array(F.struct(F.lit(None).cast("double").alias("price"), F.lit(None).cast("string").alias("priceCurrency")), F.struct((F.col("p_size") + 1.5).alias("price"), F.lit("EUR").alias("priceCurrency"))).alias("offers"))),
        F.to_json(F.struct(name(2).alias("name"), F.struct(F.lit("AggregateOffer").alias("@type"), price(2).alias("lowPrice"), price(1000).alias("highPrice"), F.lit("BRL").alias("priceCurrency")).alias("offers"))),
    ]
    block = lambda *parts: F.concat(F.lit('<script type="application/ld+json">'), *[F.lit(x) if isinstance(x, str) else x for x in parts], F.lit("</script>"))
    k = F.col("p_partkey") % 3
    ld = (
        F.when(k == 0, block(node[0]))
        .when(k == 1, F.concat(block('{"@context": "x", "@graph": [{"@type": "WebPage"}, ', node[0], ", ", node[1], "]}"), block("{broken")))
        .otherwise(F.concat(block('{"@type": "ItemList", "itemListElement": [{"item": ', node[0], '}, {"item": ', node[2], "}]}"), block("[", node[1], "]")))
    )
    html = F.concat(F.lit("<html><h1>Shop</h1>"), ld, F.lit("<del>R$ 9,00</del><p>R$ 5,00</p></html>"))
    out = pages.extract_listings_from_pages(p.select(F.concat(F.lit("https://shop.com/"), F.col("p_partkey").cast("string")).alias("url"), html.alias("html")))
    return out.select("url", "title", "price", "previous_price", "currency")


@query("spec_map", "SELECT p_partkey, '/p/' || p_partkey AS link, p_size::VARCHAR AS size, lower(p_type) AS kind FROM part")
def _(spark, d):
    """Names and values of a table of facts, of which one name repeats and one is null, and links cut at their query."""
    names, values = F.array(F.lit("Size"), F.lit(None), F.lit("Kind"), F.lit("Size")), F.array(F.col("p_size").cast("string"), F.lit("y"), F.lower("p_type"), F.lit("x"))
    m = pages.spec_map(names, values)
    p = table(spark, d, "part").select("p_partkey", T.link_clean(F.concat(F.lit("/p/"), F.col("p_partkey").cast("string"), F.lit("?a=1#b"))).alias("link"), m.alias("m"))
    return p.select("p_partkey", "link", F.try_element_at("m", F.lit("Size")).alias("size"), F.try_element_at("m", F.lit("Kind")).alias("kind"))


@query("enrich_listings", "SELECT p_partkey, least(1000.0, CASE p_partkey % 3 WHEN 0 THEN p_retailprice WHEN 1 THEN p_size + 100.5 ELSE p_size + 1100.25 END) AS price, CASE WHEN p_partkey % 2 = 0 THEN 'x' WHEN contains(p_name, 'ring') THEN 'ring' END AS brand FROM part")
def _(spark, d):
    details = pages.extract_listings_from_pages(_pages(spark, d))
    seen = table(spark, d, "part").select("p_partkey", F.concat(F.lit("https://shop.com/"), F.col("p_partkey").cast("string")).alias("url"), F.lit(1000.0).alias("price"), F.when(F.col("p_partkey") % 2 == 0, "x").alias("brand"))
    return pages.enrich_listings(seen, details, ("ring",)).select("p_partkey", "price", "brand")
