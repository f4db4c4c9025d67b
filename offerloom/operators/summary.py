"""Summaries and reports.

Means of prices are exact decimal sums over counts, so they don't depend on the order of rows. Percentiles interpolate linearly and
are exact for groups of any size (:func:`group_quantiles`); ``accuracy`` switches to the approximate form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerloom.functions.names import fresh
from offerloom.functions.text import is_blank
from offerloom.sources.scratch import written

DIGITS = 6
#: Groups of more prices than that are counted and stay spread over the tasks; those of others are sorted by group.
MOST_PRICES = 1_000_000


def exact_mean(c: Column) -> Column:
    """The mean of amounts with cents, from an exact sum."""
    return F.sum(c.cast("decimal(18,2)")).cast("double") / F.count(c)


def quantiles(c: Column, at: list[float], accuracy: int | None = None) -> Column:
    q = F.array(*map(F.lit, at))
    return F.percentile_approx(c, q, F.lit(accuracy)) if accuracy else F.percentile(c, q)


def joined_set(c: Column, sep: str = ",") -> Column:
    """Sorted distinct non-blank values as one text."""
    return F.array_join(F.array_sort(F.collect_set(F.when(F.trim(c) != "", c))), sep)


def null_safe_join(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``df`` with the columns of ``other``, whose keys are named with ``_`` at the end; null keys match null keys."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    return df.join(other, same, how).drop(*[f"{k}_" for k in keys])


def _band(v: Column) -> Column:
    """A range of values that grows with the value: 256 ranges to each doubling, mirrored for negative values, one for zero."""
    return F.coalesce(F.signum(v) * (F.floor(F.log2(F.abs(v)) * 256) + 300_000), F.lit(0)).cast("long")


def _at_rank(place: Column, first: Column, n: Column, v: Column) -> Column:
    """The value at a ``place`` between two ranks of its group; a row of ``v`` holds the ranks from ``first`` on, ``n`` of them."""
    of = lambda r: F.max(F.when((r >= first) & (r < first + n), v))
    share = F.max(place - F.floor(place))
    return of(F.floor(place)) * (1 - share) + of(F.ceil(place)) * share


BEFORE = (Window.unboundedPreceding, -1)


def _ranked(counts: DataFrame) -> DataFrame:
    """``counts`` (k, v, n) with ``first``, the rank of the first row of the value in its group, and ``total``, the group's rows.

    Rows are dealt out and sorted by ``h``, a hash of the group, and the group: one number decides nearly every comparison.
    """
    w = Window.partitionBy("h", "k")
    return counts.withColumn("h", F.xxhash64("k")).withColumns({"first": F.coalesce(F.sum("n").over(w.orderBy("v").rowsBetween(*BEFORE)), F.lit(0)), "total": F.sum("n").over(w)})


def quantiles_of_counts(counts: DataFrame, at: dict[str, float], most: int = 10_000) -> DataFrame:
    """The quantiles ``at`` (name to share) of each group, interpolated linearly; ``counts`` is a written table of (k, v, n), no nulls.

    Groups of at most ``most`` distinct values are sorted in one task each. The values of larger ones stay spread over the tasks by
    ranges of fixed relative width (:func:`_quantiles_in_bands`). Both ways are exact. The quantiles are written: a union of parts that
    are dealt out alike passes for a table dealt out like these, until one of them is planned anew, and a join with it then fails.
    """
    large = written(counts.groupBy("k").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > most).select("k"), "large")
    places = {c: (F.col("total") - 1) * F.lit(float(x)) for c, x in at.items()}
    small = _ranked(counts.join(large, "k", "left_anti")).groupBy("h", "k").agg(*[_at_rank(p, F.col("first"), F.col("n"), F.col("v")).alias(c) for c, p in places.items()])
    small = small.select("k", *at)
    return written(small if large.isEmpty() else small.unionByName(_quantiles_in_bands(counts.join(large, "k", "left_semi"), at)), "quantiles")


def _quantiles_in_bands(counts: DataFrame, at: dict[str, float]) -> DataFrame:
    """The quantiles of groups of any size: sums of the ranges of values tell which ranges hold the wanted ranks, and only those are
    sorted, each by itself; so a group with a third of all values costs no task more than a range.
    """
    spread = counts.withColumn("band", _band(F.col("v")))
    bands = spread.groupBy("k", "band").agg(F.sum("n").alias("m"))
    of_group = Window.partitionBy("k")
    bands = bands.withColumns({"start": F.coalesce(F.sum("m").over(of_group.orderBy("band").rowsBetween(*BEFORE)), F.lit(0)), "total": F.sum("m").over(of_group)})
    places = [(F.col("total") - 1) * F.lit(float(x)) for x in at.values()]
    ranks = F.array_distinct(F.array(*[f(p) for p in places for f in (F.floor, F.ceil)]))
    wanted = bands.withColumn("ranks", F.filter(ranks, lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("m")))).where(F.size("ranks") > 0).drop("m")
    inside = Window.partitionBy("k", "band").orderBy("v").rowsBetween(*BEFORE)
    ranked = spread.join(written(wanted, "ranges"), ["k", "band"]).withColumn("first", F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    hits = ranked.select("k", "v", "total", F.explode(F.filter("ranks", lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("n")))).alias("rank"))
    return hits.groupBy("k").agg(*[_at_rank(p, F.col("rank"), F.lit(1), F.col("v")).alias(c) for c, p in zip(at, places, strict=True)])


def group_quantiles(df: DataFrame, keys: list[str], value: str, at: dict[str, float], accuracy: int | None = None) -> DataFrame:
    """Keys and quantiles, rounded to DIGITS, of each group that has a value; exact for groups of any size, or by ``accuracy`` approximate."""
    v = df.where(F.col(value).isNotNull()).select(F.struct(*keys).alias("k"), F.col(value).cast("double").alias("v"))
    if accuracy:
        q = v.groupBy("k").agg(F.percentile_approx("v", F.array(*map(F.lit, at.values())), F.lit(accuracy)).alias("q"))
        q = q.select("k", *[F.col("q")[i].alias(c) for i, c in enumerate(at)])
    else:
        q = quantiles_of_counts(written(v.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")), "prices"), at)
    return q.select(*[F.col("k")[c].alias(c) for c in keys], *[F.round(c, DIGITS).alias(c) for c in at])


def _trimmed_mean() -> Column:
    """The mean of the values within [p10, p90] of rows (v, n, p10, p90)."""
    near = F.col("v").between(F.col("p10"), F.col("p90"))
    return F.sum(F.when(near, F.col("v").cast("decimal(18,2)") * F.col("n"))).cast("double") / F.sum(F.when(near, F.col("n")))


def _spread_of_small(counts: DataFrame, at: dict[str, float]) -> DataFrame:
    """Quantiles, rounded to DIGITS, and trimmed mean of each group, from one sort of its values in one task."""
    whole = Window.partitionBy("h", "k")
    places = {c: (F.col("total") - 1) * F.lit(float(x)) for c, x in at.items()}
    of = lambda r: F.max(F.when((r >= F.col("first")) & (r < F.col("first") + F.col("n")), F.col("v"))).over(whole)
    share = lambda p: p - F.floor(p)
    ranked = _ranked(counts).withColumns({c: F.round(of(F.floor(p)) * (1 - share(p)) + of(F.ceil(p)) * share(p), DIGITS) for c, p in places.items()})
    return ranked.groupBy("h", "k").agg(*[F.max(c).alias(c) for c in at], _trimmed_mean().alias("media_correta")).select("k", *at, "media_correta")


def canonical_summary(listings: DataFrame, accuracy: int | None = None) -> DataFrame:
    """A1, A2, L1: per (canonical_key, brand, model, size) counts, price statistics, marketplaces and evidence files.

    n_listings counts all rows, the statistics all prices. What is read of the listings is written, so they are worked out once. Counts,
    sums and sets come from one aggregate by group, marketplace and file. Percentiles and the trimmed mean of groups of at most
    MOST_PRICES prices come from one sort of the group's prices, which may spill; the prices of larger ones are counted, written and stay spread
    over many tasks (:func:`quantiles_of_counts`). Both parts are written before the summary is joined, as the quantiles are there.
    media_correta is the mean of the prices within [p10, p90]. With ``accuracy`` percentiles are approximate. Groups without a price
    have no marketplaces.
    """
    keys = ["canonical_key", "brand", "model", "size"]
    listings = written(listings.select(*keys, "price", "marketplace", "source_file"), "priced")
    rows = listings.select(F.struct(*keys).alias("k"), F.col("price").cast("double").alias("v"), "marketplace", "source_file")
    v = F.col("v")
    of_file = rows.groupBy("k", "marketplace", "source_file").agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("n_prices"), F.min(v).alias("low"), F.max(v).alias("high"), F.sum(v.cast("decimal(18,2)")).alias("total"))
    stats = of_file.groupBy("k").agg(
        F.sum("n").alias("n_listings"), F.sum("n_prices").alias("n_prices"), F.min("low").alias("min_price"), F.max("high").alias("max_price"),
        (F.sum("total").cast("double") / F.nullif(F.sum("n_prices"), F.lit(0))).alias("mean_price"), joined_set(F.col("marketplace")).alias("marketplaces"), joined_set(F.col("source_file")).alias("evidence_files"),
    )
    stats = written(stats, "stats")
    at = {"p10": 0.1, "median_price": 0.5, "p90": 0.9}
    prices = rows.where("v IS NOT NULL").select("k", "v")
    counted = lambda d: d.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    if accuracy:
        q = prices.groupBy("k").agg(quantiles(v, list(at.values()), accuracy).alias("q"))
        q = _with_trimmed(q.select("k", *[F.round(F.col("q")[i], DIGITS).alias(c) for i, c in enumerate(at)]), counted(prices))
    else:
        large = written(stats.where(F.col("n_prices") > MOST_PRICES).select("k"), "large")
        q = _spread_of_small(counted(prices.join(large, "k", "left_anti")), at)
        if not large.isEmpty():
            counts = written(counted(prices.join(large, "k", "left_semi")), "prices")
            of_large = quantiles_of_counts(counts, at).select("k", *[F.round(c, DIGITS).alias(c) for c in at])
            q = q.unionByName(_with_trimmed(of_large, counts))
    out = stats.join(written(q, "spread"), "k", "left")
    out = out.withColumn("marketplaces", F.when(F.col("n_prices") > 0, F.col("marketplaces")).otherwise(""))
    cols = ["n_listings", "marketplaces", "min_price", "max_price", "mean_price", "median_price", "p10", "p90", "media_correta", "evidence_files"]
    return out.select(*[F.col("k")[c].alias(c) for c in keys], *cols)


def _with_trimmed(q: DataFrame, counts: DataFrame) -> DataFrame:
    """Quantiles with the trimmed mean of their groups; they are written, so that Spark sees how few they are and not the counts travel."""
    q = written(q, "quantiles")
    return q.join(counts.join(q.select("k", "p10", "p90"), "k").groupBy("k").agg(_trimmed_mean().alias("media_correta")), "k", "left")


def in_summary_order(summary: DataFrame) -> DataFrame:
    """L1: by brand, model and size, nulls last, then by falling count."""
    return summary.orderBy(*[F.col(c).asc_nulls_last() for c in ("brand", "model", "size")], F.col("n_listings").desc_nulls_last())


def top_spread(summary: DataFrame, least: int = 5, n: int = 50) -> DataFrame:
    """L2: the groups with the widest prices."""
    return summary.where(F.col("n_listings") >= least).orderBy(F.desc(F.col("max_price") - F.col("min_price")), "canonical_key").limit(n)


def products_agg(offers: DataFrame) -> DataFrame:
    """A3: one row per product; "first" is the least by title and url.

    ``offers`` has one row for each (title, sku_norm, url), with first_seen and last_seen.
    """
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(F.col("title").alias("a"), F.col("url").alias("b"), F.col(c).alias("c"))))["c"]
    return offers.groupBy("product_id").agg(
        *[first(c).alias(c) for c in ("product_signature", "brand", "size_str", "model_norm")], F.min("title").alias("example_title"),
        F.count_distinct("url").alias("n_offers"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )


def unify_stats(offers: DataFrame) -> DataFrame:
    """A5: totals of a unification; ``offers`` has product_id and n_rows, the number of rows that it stands for."""
    s = offers.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows_in"), F.count_distinct("product_id").alias("products_out"))
    return s.select("rows_in", "products_out", F.col("rows_in").alias("offers_out"), (F.col("rows_in") / F.greatest(F.lit(1), "products_out")).alias("avg_offers_per_product"))


def brand_report(listings: DataFrame) -> DataFrame:
    """Rows, mean and median price per brand; most rows first, then the lower mean."""
    out = listings.groupBy(F.struct("brand").alias("k")).agg(F.count("canonical_key").alias("n"), exact_mean(F.col("price")).alias("mean_price"))
    median = group_quantiles(listings, ["brand"], "price", {"median_price": 0.5}).select(F.struct("brand").alias("k"), "median_price")
    out = out.join(median, "k", "left").select(F.col("k.brand").alias("brand"), "n", "mean_price", "median_price")
    return out.orderBy(F.desc("n"), "mean_price", "brand")


def dispersion_report(listings: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Quartiles, mean, sample deviation and its ratio to the mean per canonical key and brand."""
    p, keys = F.col("price"), ["canonical_key", "brand"]
    out = listings.groupBy(F.struct(*keys).alias("k")).agg(F.count(p).alias("n"), F.min(p).alias("min_price"), exact_mean(p).alias("mean_price"), F.max(p).alias("max_price"), F.round(F.stddev_samp(p), 4).alias("std_price"))
    at = {"q1": 0.25, "median_price": 0.5, "q3": 0.75}
    q = group_quantiles(listings, keys, "price", at, accuracy).select(F.struct(*keys).alias("k"), *at)
    out = out.join(q, "k", "left").withColumn("cv", F.round(F.try_divide("std_price", "mean_price"), 4))
    return out.select(*[F.col("k")[c].alias(c) for c in keys], "n", "min_price", "mean_price", "max_price", "std_price", *at, "cv")


def iqr_outliers(listings: DataFrame, k: float = 1.5, key: str = "canonical_key") -> DataFrame:
    """Rows outside [q1 - k iqr, q3 + k iqr] of their key, with the bounds; rows without key stay out."""
    d = listings.where(F.col(key).isNotNull())
    a, b = F.col("q1"), F.col("q3")
    q = group_quantiles(d, [key], "price", {"q1": 0.25, "q3": 0.75})
    q = q.select(key, F.round(a - k * (b - a), DIGITS).alias("low"), F.round(b + k * (b - a), DIGITS).alias("high"))
    return d.join(q, key).where("price < low OR price > high")


def price_describe(snapshots: DataFrame) -> DataFrame:
    """Distribution of the latest snapshot per slug, share of free shipping, change of the mean since the day before, alert.

    ``snapshots`` has slug, d (date), price and free_shipping.
    """
    p, keys = F.col("price"), ["slug", "d"]
    day = snapshots.groupBy(*keys).agg(
        F.count(p).alias("n"), F.min(p).alias("min_price"), exact_mean(p).alias("mean_price"), F.max(p).alias("max_price"),
        F.round(F.stddev_samp(p), 4).alias("std_price"), F.round(F.avg(F.col("free_shipping").cast("double")) * 100, 4).alias("pct_free_shipping"),
    )
    before = day.select("slug", F.date_add("d", 1).alias("d"), F.col("mean_price").alias("mean_before"))
    last = day.groupBy("slug").agg(F.max("d").alias("d"))
    at = {"q1": 0.25, "median_price": 0.5, "q3": 0.75}
    latest = snapshots.join(last, keys, "left_semi")
    out = day.join(last, keys, "left_semi").join(group_quantiles(latest, keys, "price", at), keys, "left").join(before, keys, "left")
    out = out.withColumn("pct_change", F.round((F.col("mean_price") / F.col("mean_before") - 1) * 100, 4))
    return out.withColumn("alert", F.coalesce(F.abs("pct_change") >= 5, F.lit(False))).drop("mean_before")


def aggregates_daily(offers: DataFrame) -> DataFrame:
    """Competitor percentiles, minimum and maximum per (sku_key, date). ``offers`` has sku_key, date and price."""
    out = offers.groupBy("sku_key", "date").agg(quantiles(F.col("price"), [0.1, 0.5, 0.9]).alias("q_"), F.min("price").alias("comp_min"), F.max("price").alias("comp_max"))
    for i, c in enumerate(("comp_p10", "comp_p50", "comp_p90")):
        out = out.withColumn(c, F.round(F.col("q_")[i], DIGITS))
    return out.drop("q_")


def term_means(snapshots: DataFrame, least_slugs: int = 2) -> DataFrame:
    """A10: mean price per slug, lowest first; nothing if there are fewer than ``least_slugs``."""
    means = snapshots.groupBy("slug").agg(exact_mean(F.col("price")).alias("mean_price"))
    enough = means.groupBy(F.lit(1).alias("one_")).agg(F.count(F.lit(1)).alias("k_")).where(F.col("k_") >= least_slugs)  # one row
    return means.withColumn("one_", F.lit(1)).join(F.broadcast(enough), "one_").select("slug", "mean_price").orderBy("mean_price", "slug")


def search_run_report(hits: DataFrame, most: int = 50) -> DataFrame:
    """Per term the number of products and promotions, the rounded mean price and the first ``most`` products.

    ``hits`` has term, title, price, url and promo. Counts cover all rows; only the nested list is limited.
    """
    totals = hits.groupBy("term").agg(F.count(F.lit(1)).alias("produtos_encontrados"), F.count_if(F.col("promo")).alias("promocoes"), F.round(exact_mean(F.col("price")), 2).alias("preco_medio"))
    w = Window.partitionBy("term").orderBy(F.col("price").asc_nulls_last(), "title", "url")
    top = hits.select("term", "title", "price", "url").withColumn("rn_", F.row_number().over(w)).where(F.col("rn_") <= most)  # each task passes on so many
    top = top.groupBy(F.col("term").alias("t_")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rn_", "title", "price", "url"))), lambda x: F.struct(x["title"].alias("titulo"), x["price"].alias("preco"), x["url"].alias("link"))).alias("produtos"))
    return totals.join(top, F.col("term").eqNullSafe(F.col("t_")), "left").drop("t_")


def first_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    (rank,) = fresh(df, "rn_")
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col(rank) <= n).drop(rank)


def cheapest_n_mean(hits: DataFrame, n: int = 10, group: str = "term") -> DataFrame:
    """The mean of the ``n`` lowest prices of each group."""
    low = first_per_group(hits.where("price IS NOT NULL").select(group, "price"), group, [F.col("price")], n)
    return low.groupBy(group).agg(exact_mean(F.col("price")).alias("mean_price"), F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, group: str, value: str, k: int, weight: str | None = None) -> DataFrame:
    """Per group the ``k`` most frequent non-blank values, most frequent first, as an array; ties by value.

    Values are counted before they are ranked, so a value with very many rows is one row in the window. Rows count ``weight`` times.
    """
    n, rank = fresh(df, "n_", "rn_")
    counts = df.where(~is_blank(F.col(value))).groupBy(group, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias(n))
    top = counts.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(F.desc(n), value))).where(F.col(rank) <= k)
    return top.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct(rank, value))), lambda x: x[value]).alias(f"top_{value}"))


def price_examples(df: DataFrame, group: str = "canonical_key", weight: str | None = None) -> DataFrame:
    """The rows with the lowest, the upper-median and the highest price of each group, one per url, those without url left out.

    Rows without a price or a group don't count, others ``weight`` times. Ranks of the prices come from their counts, and the wanted
    prices are written; only rows of these are counted and ranked, and equal rows as one.
    """
    of_group, before = Window.partitionBy(group), (Window.unboundedPreceding, -1)
    fields = [group, "title", "price", "seller", "marketplace", "url"]
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    d = df.where(F.col("price").isNotNull() & F.col(group).isNotNull())
    prices = d.groupBy(group, "price").agg(rows.alias("c_"))
    prices = prices.withColumns({"before_": F.coalesce(F.sum("c_").over(of_group.orderBy("price").rowsBetween(*before)), F.lit(0)), "n_": F.sum("c_").over(of_group)})
    wanted = F.array_distinct(F.array(F.lit(1).cast("long"), F.floor(F.col("n_") / 2) + 1, F.col("n_")))
    inside = lambda first, n: lambda k: (k > first) & (k <= first + n)
    prices = prices.withColumn("want_", F.filter(wanted, inside(F.col("before_"), F.col("c_")))).where(F.size("want_") > 0)
    prices = written(prices.drop("c_", "n_"), "wanted")
    d = d.join(prices.select(group, "price"), [group, "price"], "left_semi").groupBy(*fields).agg(rows.alias("m_")).join(prices, [group, "price"])
    within = Window.partitionBy(group, "price").orderBy("url", "title", "seller", "marketplace").rowsBetween(*before)
    d = d.withColumn("first_", F.col("before_") + F.coalesce(F.sum("m_").over(within), F.lit(0)))
    d = d.withColumn("rn_", F.array_min(F.filter("want_", inside(F.col("first_"), F.col("m_"))))).where("rn_ IS NOT NULL").where(~is_blank(F.col("url")))
    d = d.withColumn("u_", F.row_number().over(Window.partitionBy(group, "url").orderBy("rn_"))).where("u_ = 1")
    return d.select(group, F.row_number().over(of_group.orderBy("rn_")).alias("example"), "title", "price", "seller", "marketplace", "url")


def _unpivot(row: DataFrame, names: list[str], name: str, value: str) -> DataFrame:
    return row.unpivot([], names, name, value)


def missing_rate(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column the share of rows that are null or blank, in one pass."""
    row = df.agg(*[F.round(F.avg(is_blank(F.col(c)).cast("double")), 6).alias(c) for c in columns])
    return _unpivot(row, columns, "column_name", "missing")


def fill_rate(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column the share of rows that have a value."""
    return missing_rate(df, columns).select("column_name", F.round(1 - F.col("missing"), 6).alias("filled"))


def missing_by_marketplace(df: DataFrame, columns=("brand", "model", "size", "seller")) -> DataFrame:
    """Rows and percent missing per marketplace, most rows first."""
    out = df.groupBy("marketplace").agg(F.count(F.lit(1)).alias("n_rows"), *[F.round(F.avg(is_blank(F.col(c)).cast("double")) * 100, 4).alias(f"{c}_missing") for c in columns])
    return out.orderBy(F.desc("n_rows"), "marketplace")


def count_by(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value, most first."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col(column).asc_nulls_last())
    return out.limit(n) if n else out


def count_where(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows that meet each condition, in one pass."""
    row = df.agg(*[F.count_if(c).alias(k) for k, c in conditions.items()])
    return _unpivot(row, list(conditions), "metric", "n")


def snapshot_mean(snapshots: DataFrame) -> DataFrame:
    """Mean price of each snapshot (slug, d)."""
    return snapshots.groupBy("slug", "d").agg(exact_mean(F.col("price")).alias("mean_price"))


def regression_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mean absolute and root mean squared error."""
    e = F.col(prediction) - F.col(label)
    return scored.agg(F.round(F.avg(F.abs(e)), 4).alias("mae"), F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"))


def db_summary(df: DataFrame, sku: str = "sku_norm", when: str = "captured_at") -> DataFrame:
    """Rows, distinct SKUs, rows per SKU and range of dates."""
    s = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(sku).alias("n_skus"), F.min(when).alias("first_date"), F.max(when).alias("last_date"))
    return s.withColumn("rows_per_sku", F.try_divide("n_rows", "n_skus"))
