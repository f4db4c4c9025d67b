"""Audit requests, replies and the approved set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.operators.quality import precheck_price_sanity, precheck_title_flags
from offerloom.operators.summary import brand_report, dispersion_report, iqr_outliers, price_examples, top_values
from offerloom.sources.scratch import written


def audit_sample(summary: DataFrame, listings: DataFrame, titles: int = 5, sellers: int = 3) -> DataFrame:
    """Each group with its most frequent titles and sellers, its price examples and its precheck alerts.

    The summary is written, and so is what the samples show of the listings of its groups; titles, sellers and examples are read from
    these rows, instead of a query per group.
    """
    shown = ["canonical_key", "title", "price", "seller", "marketplace", "url"]
    summary = written(summary, "groups")
    mine = written(listings.select(*shown).join(summary.select("canonical_key"), "canonical_key", "left_semi"), "sample")
    ex = price_examples(mine).groupBy("canonical_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("example", "title", "price", "seller", "marketplace"))), lambda x: x.dropFields("example")).alias("examples"))
    d = summary.join(top_values(mine, "canonical_key", "title", titles), "canonical_key", "left")
    d = d.join(top_values(mine, "canonical_key", "seller", sellers), "canonical_key", "left").join(ex, "canonical_key", "left")
    return d.withColumn("precheck_alerts", F.array_union(precheck_price_sanity(), F.coalesce(precheck_title_flags(F.col("top_title")), F.array().cast("array<string>"))))


def audit_requests(sample: DataFrame) -> DataFrame:
    """Per group one JSON document for an external reviewer."""
    prices = F.struct(F.col("min_price").alias("min"), "p10", F.col("median_price").alias("median"), "p90", F.col("max_price").alias("max"), "media_correta")
    doc = F.struct("brand", "model", "size", "n_listings", prices.alias("prices"), F.col("top_title").alias("titles_sample"), F.col("top_seller").alias("sellers_top"), "examples")
    return sample.select("canonical_key", "precheck_alerts", F.to_json(doc).alias("request"))


def parse_audit_responses(replies: DataFrame) -> DataFrame:
    """``reply`` (canonical_key, reply; null for a failed call) as llm_ok, llm_alerts and llm_confidence.

    Text that is no JSON object gives false, ``llm_invalid_json_response`` and 0; a failed call ``llm_request_failed``.
    """
    schema = "ok boolean, alerts array<string>, confidence double, bad_ string"
    r = F.from_json(F.trim("reply"), schema, {"columnNameOfCorruptRecord": "bad_", "mode": "PERMISSIVE"})
    d = replies.withColumn("r_", r)
    failed, bad = F.col("reply").isNull(), F.col("r_").isNull() | F.col("r_.bad_").isNotNull() | ~F.startswith(F.trim("reply"), F.lit("{"))
    return d.select(
        "canonical_key",
        F.when(failed | bad, False).otherwise(F.coalesce("r_.ok", F.lit(False))).alias("llm_ok"),
        F.when(failed, F.array(F.lit("llm_request_failed"))).when(bad, F.array(F.lit("llm_invalid_json_response"))).otherwise(F.coalesce("r_.alerts", F.array().cast("array<string>"))).alias("llm_alerts"),
        F.when(failed | bad, 0.0).otherwise(F.coalesce("r_.confidence", F.lit(0.0))).alias("llm_confidence"),
    )


def approved(threshold: float = 0.70, exclude_prechecks: bool = False) -> Column:
    ok = F.coalesce(F.col("llm_ok"), F.lit(False)) & (F.coalesce("llm_confidence", F.lit(0.0)) >= threshold)
    return ok & (F.coalesce(F.size("precheck_alerts"), F.lit(0)) == 0) if exclude_prechecks else ok


def approved_listings(listings: DataFrame, audit: DataFrame, threshold: float = 0.70, exclude_prechecks: bool = False) -> DataFrame:
    """Listings of approved groups."""
    return listings.join(audit.where(approved(threshold, exclude_prechecks)).select("canonical_key"), "canonical_key")


def audit_counts(listings: DataFrame, audit: DataFrame, threshold: float = 0.70, exclude_prechecks: bool = False) -> DataFrame:
    """Listings kept and dropped; groups without an audit count as dropped."""
    marks = audit.select("canonical_key", approved(threshold, exclude_prechecks).alias("ok_"))
    ok = F.coalesce("ok_", F.lit(False))
    return listings.join(marks, "canonical_key", "left").agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"), F.count(F.lit(1)).alias("total"))


def summary_of_keys(summary: DataFrame, listings: DataFrame) -> DataFrame:
    """Summary rows whose key has a listing."""
    return summary.join(listings.select("canonical_key"), "canonical_key", "left_semi")


def generate_final(listings: DataFrame, summary: DataFrame, audit: DataFrame, threshold: float = 0.70, exclude_prechecks: bool = False, sections: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """C11: the final tables, counts and reports of the approved groups, or those of ``sections``."""
    final = approved_listings(listings, audit, threshold, exclude_prechecks)
    make = {
        "unified_listings_final": lambda: final, "canonical_summary_final": lambda: summary_of_keys(summary, final), "counts": lambda: audit_counts(listings, audit, threshold, exclude_prechecks),
        "brand_report": lambda: brand_report(final), "dispersion_report": lambda: dispersion_report(final), "outliers": lambda: iqr_outliers(final),
    }
    return {name: make[name]() for name in sections or make}
