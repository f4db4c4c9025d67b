"""Data checks, prechecks and backfills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerloom.config import MatchConfig
from offerloom.functions import attributes as E
from offerloom.functions.names import fresh
from offerloom.functions.text import blank_to_null, is_blank
from offerloom.operators.dedup import keep_first_by
from offerloom.operators.summary import count_where, joined_set, missing_by_marketplace, missing_rate, null_safe_join, top_spread
from offerloom.sources.scratch import written

LISTING_COLUMNS = ("marketplace", "title", "price", "url", "brand", "model", "size", "canonical_key", "collected_at", "seller", "source_file")
SUMMARY_COLUMNS = ("canonical_key", "brand", "model", "size", "n_listings", "marketplaces", "min_price", "max_price", "mean_price", "median_price", "p10", "p90", "media_correta", "evidence_files")
TRIPLET = ["brand", "model", "size"]

# Patterns of the title prechecks.
TITLE_KIT = "(?i)(?<![a-z0-9])(?:kit|jogo|par|dupla|conjunto|combo|lote|cx|caixa|c/|pack|pckt|pacote|(?:[24568]|10)x|x[2468])(?![a-z0-9])"
TITLE_UNITS = "(?i)\\b[0-9]{1,2}\\s?(?:un|uni|unid|unidades|pçs|pcs|peças)\\b"
TITLE_RIM = "(?i)\\b(?:aro|rin)\\s?[0-9]{2}\\b"


def audit_df(df: DataFrame, columns=("brand", "model", "size", "seller"), n: int | None = 5000) -> dict[str, DataFrame]:
    """Missing rates, missing rates by marketplace, and the first ``n`` rows with something missing (None: all, in no order)."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | is_blank(F.col(c))
    issues = df.where(bad)
    if n is not None:
        issues = issues.orderBy("marketplace", "url", "title", *columns).limit(n)
    return {"missing_rate": missing_rate(df, list(columns)), "missing_by_marketplace": missing_by_marketplace(df, columns), "issues": issues}


def precheck_price_sanity(s: str = "") -> Column:
    """The alert codes (fixed values) of a summary row, as an array."""
    c = lambda x: F.col(s + x)
    lo, hi, mean, med, p10, p90, n = (c(x) for x in ("min_price", "max_price", "mean_price", "median_price", "p10", "p90", "n_listings"))
    known = lo.isNotNull() & hi.isNotNull()
    alerts = F.array_compact(F.array(
        F.when(~known, "precheck_missing_min_max"),
        F.when(known & (lo <= 0), "precheck_nonpositive_min"),
        F.when(known & (hi < lo), "precheck_max_less_than_min").when(known & (lo > 0) & (F.try_divide(hi, lo) > 3.5), "precheck_high_spread"),
        F.when((med != 0) & (F.abs(F.try_divide(mean - med, med)) > 0.25), "precheck_mean_median_divergence"),
        F.when((p10 > 0) & (F.try_divide(p90, p10) > 3.0), "precheck_wide_p10_p90"),
        F.when(n < 4, "precheck_low_sample_reliability"),
    ))
    return F.when(F.coalesce(n, F.lit(0)) <= 0, F.array(F.lit("precheck_no_listings"))).otherwise(alerts)


def precheck_title_flags(titles: Column) -> Column:
    """Alert codes if any of the titles (an array) looks like a kit, several units, or names a rim apart."""
    any_like = lambda p: F.exists(titles, lambda t: t.rlike(p))
    return F.array_compact(F.array(
        F.when(any_like(TITLE_KIT), "precheck_title_maybe_kit_or_multiunit"), F.when(any_like(TITLE_UNITS), "precheck_title_explicit_multiunit"), F.when(any_like(TITLE_RIM), "precheck_title_extra_rim_dimension"),
    ))


def missing_columns(df: DataFrame, expected: tuple[str, ...]) -> DataFrame:
    """Expected columns that ``df`` lacks."""
    spark = df.sparkSession
    want = spark.createDataFrame([(c,) for c in expected], "column_name string")
    have = spark.createDataFrame([(c,) for c in df.columns], "column_name string")
    return want.join(have, "column_name", "left_anti")


def unfilled_columns(df: DataFrame, expected: tuple[str, ...]) -> DataFrame:
    """Expected columns that ``df`` lacks or that hold no value in any row: the union of the names minus those with a value."""
    here = [c for c in expected if c in df.columns]
    counts = count_where(df, {c: ~is_blank(F.col(c)) for c in here}).where("n > 0").select(F.col("metric").alias("column_name")) if here else None
    want = df.sparkSession.createDataFrame([(c,) for c in expected], "column_name string")
    return want if counts is None else want.join(counts, "column_name", "left_anti")


def _rows(weight: str | None) -> Column:
    """The number of rows: of the frame, or those that its pre-aggregated rows stand for."""
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def key_with_many_triplets(df: DataFrame) -> DataFrame:
    """Keys that stand for several (brand, model, size)."""
    out = df.groupBy("canonical_key").agg(F.count_distinct(F.struct(*TRIPLET)).alias("distinct_triplets"))
    return out.where("distinct_triplets > 1").orderBy(F.desc("distinct_triplets"), "canonical_key")


def triplet_with_many_keys(df: DataFrame) -> DataFrame:
    """(brand, model, size) with several keys."""
    return df.groupBy(*TRIPLET).agg(F.count_distinct("canonical_key").alias("n_keys")).where("n_keys > 1").orderBy(F.desc("n_keys"), *TRIPLET)


def duplicate_urls(df: DataFrame, n: int = 50, weight: str | None = None) -> DataFrame:
    """(marketplace, url) that occur more than once, most often first."""
    return df.groupBy("marketplace", "url").agg(_rows(weight).alias("n")).where("n > 1").orderBy(F.desc("n"), "marketplace", "url").limit(n)


def multi_source_items(df: DataFrame, n: int = 100, weight: str | None = None) -> DataFrame:
    """Products that come from several files, with the files."""
    per_file = df.where("brand <> '' AND model <> '' AND size <> ''").groupBy(*TRIPLET, "source_file").agg(_rows(weight).alias("k"))
    out = per_file.groupBy(*TRIPLET).agg(F.sum("k").alias("n_rows"), F.count("source_file").alias("n_sources")).where("n_sources >= 2")
    top = out.orderBy(F.desc("n_sources"), F.desc("n_rows"), *TRIPLET).limit(n)
    # Names of these products only, and of each no more than 300 characters can hold.
    names = per_file.where(F.trim("source_file") != "").join(top.select(*TRIPLET), TRIPLET, "left_semi")
    names = names.withColumn("rank", F.row_number().over(Window.partitionBy(*TRIPLET).orderBy("source_file"))).where("rank <= 100")
    snippet = F.substring(F.array_join(F.array_sort(F.collect_list("source_file")), " | "), 1, 300).alias("sources_snippet")
    return top.join(names.groupBy(*TRIPLET).agg(snippet), TRIPLET, "left").withColumn("sources_snippet", F.coalesce("sources_snippet", F.lit(""))).orderBy(F.desc("n_sources"), F.desc("n_rows"), *TRIPLET)


def same_brand_and_model(df: DataFrame, n: int = 50, weight: str | None = None) -> DataFrame:
    """Products whose model is their brand."""
    d = df.where((F.col("brand") != "") & (F.col("model") != "") & (F.lower("brand") == F.lower("model")))
    return d.groupBy(*TRIPLET).agg(_rows(weight).alias("n")).orderBy(F.desc("n"), *TRIPLET).limit(n)


def evidence_coverage(summary: DataFrame, listings: DataFrame, n: int = 50) -> DataFrame:
    """For the largest groups the stored evidence beside the files that the listings come from."""
    top = summary.orderBy(F.desc("n_listings"), "canonical_key").limit(100)
    real = listings.groupBy(*TRIPLET).agg(joined_set(F.col("source_file")).alias("real_sources"))
    out = top.join(real, TRIPLET).orderBy(F.desc("n_listings"), "canonical_key").limit(n)
    return out.select(*TRIPLET, "n_listings", F.length("evidence_files").alias("len_evidence"), F.length("real_sources").alias("len_real"), F.substring("evidence_files", 1, 200).alias("evidence_snippet"), F.substring("real_sources", 1, 200).alias("real_snippet"))


def marketplace_divergence(summary: DataFrame, listings: DataFrame, n: int = 50) -> DataFrame:
    """Groups whose stored marketplaces are not those of their listings."""
    real = listings.groupBy(*TRIPLET).agg(joined_set(F.col("marketplace")).alias("real_mkts"))
    out = summary.join(real, TRIPLET).where((F.trim("marketplaces") != "") & (F.col("marketplaces") != F.col("real_mkts")))
    return out.select(*TRIPLET, F.substring("marketplaces", 1, 80).alias("marketplaces_summary"), F.substring("real_mkts", 1, 80).alias("marketplaces_real")).orderBy(*TRIPLET).limit(n)


def evidence_from(summary: DataFrame, tails: tuple[str, ...]) -> DataFrame:
    """Groups whose evidence holds each path tail."""
    return count_where(summary, {t: F.contains("evidence_files", F.lit(t)) for t in tails})


def run_validations(listings: DataFrame, summary: DataFrame, tails=("MercadoLivre/data/raw/", "MagazineLuiza/data/raw/", "pneustore/dados/raw/"), sections: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Every validation section by name, or those of ``sections``.

    The listings are aggregated once to (key, brand, model, size, marketplace, url, file) with their number and that of bad prices; all
    sections but the sample of raw rows read this. It is written unless only one section is asked for.
    """
    slim = ["canonical_key", *TRIPLET, "marketplace", "url", "source_file"]
    bad = F.count_if(F.coalesce(F.col("price") <= 0, F.lit(True)))
    d = listings.groupBy(*slim).agg(F.count(F.lit(1)).alias("n_rows"), bad.alias("n_bad"))
    if sections is None or len(sections) > 1:
        d = written(d, "validations")
    blank = lambda c: is_blank(F.col(c))

    def weighed(conditions: dict[str, Column], weight: str = "n_rows") -> DataFrame:
        row = d.agg(*[F.coalesce(F.sum(F.when(c, F.col(weight))), F.lit(0)).alias(k) for k, c in conditions.items()])
        return row.unpivot([], list(conditions), "metric", "n")

    def by(column: str, n: int | None = None) -> DataFrame:
        out = d.groupBy(column).agg(_rows("n_rows").alias("n")).orderBy(F.desc("n"), F.col(column).asc_nulls_last())
        return out.limit(n) if n else out

    make = {
        "missing_cols_unified_listings": lambda: missing_columns(listings, LISTING_COLUMNS),
        "missing_cols_canonical_summary": lambda: missing_columns(summary, SUMMARY_COLUMNS),
        "critical_blanks": lambda: weighed({"rows_without_source_file": blank("source_file"), "rows_without_canonical_key": blank("canonical_key"), "rows_without_brand_or_model_or_size": blank("brand") | blank("model") | blank("size")}),
        "count_by_marketplace": lambda: by("marketplace"),
        "count_by_size": lambda: by("size", 100),
        "brand_equals_model": lambda: same_brand_and_model(d, weight="n_rows"),
        "bad_prices": lambda: weighed({"negative_or_zero_prices": F.lit(True)}, "n_bad"),
        "top_spread": lambda: top_spread(summary),
        "evidence_samples": lambda: summary.where(F.trim("evidence_files") != "").orderBy(F.desc("n_listings"), "canonical_key").limit(50).select(*TRIPLET, "n_listings", "marketplaces", F.substring("evidence_files", 1, 200).alias("evidence_snippet")),
        "evidence_tails": lambda: evidence_from(summary, tails),
        "backslashes": lambda: weighed({"n_with_backslash": F.contains("source_file", F.lit("\\"))}),
        "key_with_many_triplets": lambda: key_with_many_triplets(d),
        "triplet_with_many_keys": lambda: triplet_with_many_keys(d),
        "duplicate_urls": lambda: duplicate_urls(d, weight="n_rows"),
        "multi_source_items": lambda: multi_source_items(d, weight="n_rows"),
        "evidence_coverage": lambda: evidence_coverage(summary, d),
        "marketplace_divergence": lambda: marketplace_divergence(summary, d),
        "raw_listings": lambda: listings.orderBy("canonical_key", "url", "collected_at", "seller").limit(10),
        "raw_summary": lambda: summary.orderBy("canonical_key").limit(10),
    }
    return {name: make[name]() for name in sections or make}


def verify_snapshot(df: DataFrame, key=("marketplace", "sku_norm"), required=("marketplace", "sku_norm", "title", "price", "url", "captured_at")) -> DataFrame:
    """One row per check of a snapshot: check, n_bad, ok."""
    lacking = missing_columns(df, required).agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit("required_columns").alias("check"), "n_bad")
    here = [c for c in required if c in df.columns]
    conditions = {f"null_{c}": F.col(c).isNull() for c in here}
    if "price" in here:
        conditions["price_not_positive"] = F.col("price") <= 0
    counts = count_where(df, conditions).withColumnRenamed("metric", "check")
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("c"), F.count_if(F.lit(False)).alias("z"))
    repeated = per_key.agg(F.count_if(F.col("c") > 1).alias("n_bad")).select(F.lit("duplicate_keys").alias("check"), "n_bad")
    out = lacking.unionByName(counts.withColumnRenamed("n", "n_bad")).unionByName(repeated)
    if "captured_at" in here:
        newest = df.groupBy(*key).agg(F.max("captured_at").alias("newest"))
        old = df.join(newest, list(key)).where("captured_at < newest").agg(F.count(F.lit(1)).alias("n_bad"))
        out = out.unionByName(old.select(F.lit("not_latest").alias("check"), "n_bad"))
    return out.withColumn("ok", F.col("n_bad") == 0)


def evidence_values(evidence: DataFrame, json_column: str | None, config: MatchConfig, url: str = "url") -> DataFrame:
    """Per url one row of candidate brand, model, size and seller: own column, then a field of the JSON text, then the title.

    The JSON text is parsed once a row. Evidence repeats its titles, so attributes are worked out once for each distinct lot of title
    and fields and joined back; the rows are written, as both steps read them.
    """
    names = {  # fixed values: fields of the evidence
        "title": ("title", "titulo", "name", "produto", "product_title"), "seller": ("seller", "vendedor", "loja", "seller_name"),
        "brand": ("brand", "brand_raw", "marca"), "model": ("model", "model_raw", "modelo"), "size": ("size", "tamanho", "medida"),
    }
    inside = {}
    if json_column:
        fields = [c for field in names.values() for c in field]
        inside = dict(zip(fields, fresh(evidence, *[f"json_{c}_" for c in fields]), strict=True))
        evidence = evidence.select("*", F.json_tuple(F.col(json_column), *fields).alias(*inside.values()))

    def pick(field: str) -> Column:
        own = [F.col(c).cast("string") for c in names[field] if c in evidence.columns] + [F.col(inside[c]) for c in names[field] if inside]
        return F.coalesce(*map(blank_to_null, own), F.lit(None).cast("string"))

    text = F.coalesce(pick("title"), F.col(json_column) if json_column else F.lit(None).cast("string"))
    d = evidence.select(F.col(url).alias("url"), *[pick(f).alias(f) for f in ("seller", "brand", "model", "size")], text.alias("text_")).where(~is_blank(F.col("url")))
    d = written(keep_first_by(d, ["url"]), "evidence")
    raw = ["brand", "model", "size", "text_"]
    of = d.select(*[F.col(c).alias(f"{c}_") for c in raw]).distinct()
    title, given = F.col("text__"), F.lit(None)
    of = of.withColumn("brand_new", F.coalesce("brand_", blank_to_null(E.extract_brand(given, title, config, alias_first=True))))
    of = of.withColumn("size_new", F.coalesce("size_", blank_to_null(E.extract_size_multi(title))))
    model = E.canon_model(F.coalesce("model_", blank_to_null(E.extract_model(given, title, F.col("brand_new"), config))), config, strip_codes=True)
    of = of.withColumn("model_new", blank_to_null(model))
    return null_safe_join(d, of, raw).select("url", "seller", *[F.col(f"{c}_new").alias(c) for c in ("brand", "model", "size")])


def backfill_from_evidence(listings: DataFrame, evidence: DataFrame, json_column: str | None = None, config: MatchConfig | None = None) -> dict[str, DataFrame]:
    """Suggestions for blank brand, model, size and seller from evidence with the same url, and the listings with them filled.

    suggestions_by_row has the listing's other columns beside them.
    """
    from offerloom.config import DEFAULT

    fields = ("brand", "model", "size", "seller")
    cand = evidence_values(evidence, json_column, config or DEFAULT).withColumnsRenamed({c: f"{c}_new" for c in fields} | {"url": "url_"})
    joined = listings.join(cand, F.col("url") == F.col("url_"), "left")
    need = lambda c: is_blank(F.col(c)) & F.col(f"{c}_new").isNotNull()
    any_need = F.lit(False)
    for c in fields:
        any_need = any_need | F.coalesce(need(c), F.lit(False))
    of_row = joined.where(any_need).select(*[c for c in listings.columns if c not in fields], *[F.when(need(c), F.col(f"{c}_new")).alias(c) for c in fields])
    suggestions = of_row.select("url", *fields)
    filled = joined.select(*[F.coalesce(blank_to_null(F.col(c)), F.col(f"{c}_new")).alias(c) if c in fields else F.col(c) for c in listings.columns])
    return {"suggestions": suggestions, "suggestions_by_row": of_row, "filled": filled}
