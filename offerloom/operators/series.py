"""Price series and snapshots."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerloom.functions import numbers as N
from offerloom.functions.names import fresh
from offerloom.operators.summary import snapshot_mean
from offerloom.sources.scratch import written


def exact_quantiles(df: DataFrame, at: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """Exact quantiles of whole columns, ``at``: name to (column, share), interpolated linearly; nulls don't count, None without values.

    All columns in one pass: distinct (column, value) are counted, sorted into ranges over the tasks and written. Sums of the ranges tell
    which of them hold the wanted ranks, and only these are ranked, each in a task of its own. What comes to the driver are two
    values for each quantile.
    """
    columns = list(dict.fromkeys(c for c, _ in at.values()))
    shares = [sorted({q for c, q in at.values() if c == column}) for column in columns]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("v")) for k, c in enumerate(columns)])).alias("x")).select("x.*")
    counts = long.where("v IS NOT NULL").groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"))
    dealt = written(counts.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id()), "counts")
    of_column = Window.partitionBy("k")
    parts = dealt.groupBy("k", "part").agg(F.sum("c").alias("n"))
    parts = parts.select("k", "part", "n", F.coalesce(F.sum("n").over(of_column.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"), F.sum("n").over(of_column).alias("total"))
    wanted = F.array(*[F.array(*map(F.lit, q)) for q in shares])[F.col("k")]
    places = F.transform(wanted, lambda q: (F.col("total") - 1) * q)
    ranks = F.array_distinct(F.concat(F.transform(places, lambda p: F.floor(p)), F.transform(places, lambda p: F.ceil(p))))
    parts = parts.withColumn("ranks", F.filter(ranks, lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n")))).where(F.size("ranks") > 0)
    inside = Window.partitionBy("k", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.join(F.broadcast(parts), ["k", "part"]).withColumn("first", F.col("start") + F.coalesce(F.sum("c").over(inside), F.lit(0)))  # two rows a quantile
    found = ranked.select("k", "v", "total", F.explode(F.filter("ranks", lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("c")))).alias("rank")).collect()
    values, totals = {(r.k, r["rank"]): r.v for r in found}, {r.k: r.total for r in found}
    out: dict[str, float | None] = {}
    for name, (column, q) in at.items():
        k = columns.index(column)
        if k not in totals:
            out[name] = None
            continue
        place = (totals[k] - 1) * q
        low, high, share = values[k, math.floor(place)], values[k, math.ceil(place)], place - math.floor(place)
        out[name] = low * (1 - share) + high * share
    return out


def clip_quantiles(df: DataFrame, column: str, lo: float = 0.01, hi: float = 0.99, accuracy: int | None = None) -> DataFrame:
    """Values outside two quantiles of the whole column are set to these; ``accuracy`` uses approximate ones."""
    if accuracy:
        low, high = df.agg(F.percentile_approx(column, F.array(F.lit(lo), F.lit(hi)), F.lit(accuracy))).first()[0] or (None, None)
    else:
        q = exact_quantiles(df, {"low": (column, lo), "high": (column, hi)})
        low, high = q["low"], q["high"]
    low, high = (F.round(F.lit(x).cast("double"), 6) for x in (low, high))
    return df.withColumn(column, F.when(F.col(column).isNotNull(), F.least(F.greatest(F.col(column), low), high)))


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls become the median of their column. The rows are written once, the medians found in one pass over them."""
    df = written(df, "imputed")
    medians = exact_quantiles(df, {c: (c, 0.5) for c in columns})
    return df.withColumns({c: F.coalesce(F.col(c), F.round(F.lit(medians[c]).cast("double"), 6)) for c in columns})


def in_ranges(df: DataFrame, key: str, order: list[str], rows_before: int) -> tuple[DataFrame, str, str]:
    """The rows of long series in ranges of their order, each with the rows before it; the names of the range column and of the mark of added rows.

    Rows are sorted over the tasks by key and order, so one series is many ranges. A range that goes on with the series of the one
    before gets that series' last ``rows_before`` rows again, marked, whether one range or several hold them.
    """
    part, added, rank, number = fresh(df, "range_", "added_", "rank_", "number_")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = written(df.repartitionByRange(n, key, *order).withColumn(part, F.spark_partition_id()), "ranges")
    last = Window.partitionBy(key, part).orderBy(*[F.col(c).desc() for c in order])
    tails = d.withColumn(rank, F.row_number().over(last)).where(F.col(rank) <= rows_before).drop(rank)  # so many rows of each series and range
    tails = tails.withColumn(number, F.row_number().over(Window.partitionBy(key).orderBy(part, *order)))
    ends = tails.groupBy(key, part).agg(F.min(number).alias(number)).where(F.col(number) > 1)
    wanted = ends.select(F.col(key).alias("key_"), F.col(part).alias("part_"), F.explode(F.sequence(F.greatest(F.lit(1), F.col(number) - rows_before), F.col(number) - 1)).alias("n_"))
    before = tails.join(wanted, F.col(key).eqNullSafe(F.col("key_")) & (F.col(number) == F.col("n_")))
    out = d.withColumn(added, F.lit(False)).unionByName(before.select(*df.columns, F.col("part_").alias(part), F.lit(True).alias(added)))
    return out, part, added


def series_features(df: DataFrame, key: str = "product_id", when: str = "data_coleta", price: str = "preco", threshold: float = 0.3, tie: tuple[str, ...] = (), most_rows: int = 1_000_000) -> DataFrame:
    """Difference to the price before, means of the last 7 and 30 rows, and whether the difference exceeds 30 %.

    Rows of one time follow ``tie``. Series of more than ``most_rows`` rows are cut into ranges, each with the 30 rows before it, so one
    product with a third of all rows is many tasks; the others are windows of one task each. Both give the same rows.
    """
    p, order = F.col(price), list(dict.fromkeys(c for c in (when, *tie) if c != key))

    def features(d: DataFrame, *by: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order)

        def mean(n: int) -> Column:
            frame = w.rowsBetween(-(n - 1), 0)
            return F.sum(p.cast("decimal(20,6)")).over(frame).cast("double") / F.count(p).over(frame)

        d = d.withColumns({"preco_diff": p - F.lag(p).over(w), "preco_ma7": mean(7), "preco_ma30": mean(30)})
        return d.withColumn("anomaly", F.coalesce((F.abs("preco_diff") > p * threshold).cast("int"), F.lit(0)))

    (one,) = fresh(df, "key_")
    long = written(df.groupBy(F.col(key).alias(one)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_rows).select(one), "long")
    if long.isEmpty():
        return features(df, key)
    same = F.col(key).eqNullSafe(F.col(one))
    rows, part, added = in_ranges(df.join(long, same, "left_semi"), key, order, 30)
    cut = features(rows, key, part).where(~F.col(added)).drop(part, added)
    return features(df.join(long, same, "left_anti"), key).unionByName(cut)


def price_features(df: DataFrame, money_style: str = "auto_tail") -> DataFrame:
    """C14: ``preco``, ``estoque`` and ``data_coleta`` cleaned, calendar columns, winsorised prices and series features per product."""
    kinds = dict(df.dtypes)
    d = df.withColumn("preco", N.to_price(F.col("preco"), kinds["preco"], money_style))
    if "estoque" in kinds:
        d = d.withColumn("estoque", N.parse_stock(F.col("estoque")))
    d = impute_median(d.withColumn("data_coleta", N.to_ts(F.col("data_coleta"), kinds["data_coleta"])), ["preco"])
    d = d.withColumns({"dia_semana": N.weekday_of(F.col("data_coleta")), "fim_de_semana": N.is_weekend(F.col("data_coleta"))})
    return series_features(clip_quantiles(d, "preco"), tie=tuple(c for c, t in d.dtypes if not t.startswith(("map", "variant"))))


def price_change(snapshots: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Per slug and day the mean price, the mean of the snapshot before, the change and whether it reaches ``threshold``."""
    w = Window.partitionBy("slug").orderBy("d")
    d = snapshot_mean(snapshots).withColumn("mean_before", F.lag("mean_price").over(w))
    d = d.withColumn("change", F.round(F.try_divide(F.col("mean_price") - F.col("mean_before"), "mean_before"), 6))
    up = F.when(F.col("change") > 0, "up").when(F.col("change") < 0, "down").otherwise("same")
    return d.withColumns({"flag": F.coalesce(F.abs("change") >= threshold, F.lit(False)), "direction": F.when(F.col("change").isNotNull(), up)})


def compare_with_days_before(snapshots: DataFrame, n: int) -> DataFrame:
    """The mean of each snapshot beside that of ``n`` days earlier."""
    m = snapshot_mean(snapshots)
    before = m.select("slug", F.date_add("d", n).alias("d"), F.col("mean_price").alias("mean_before"))
    return m.join(before, ["slug", "d"], "left")


def variation_alerts(snapshots: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Subject and body of an alert for each change that reaches ``threshold``."""
    d = price_change(snapshots, threshold).where("flag")
    pct = F.round(F.col("change") * 100, 1).cast("string")
    subject = F.concat(F.lit("Price alert: "), "slug", F.lit(" "), "direction", F.lit(" "), pct, F.lit("%"))
    body = F.concat("slug", F.lit(" on "), F.date_format("d", "yyyy-MM-dd"), F.lit(": mean price changed by "), pct, F.lit("%"))
    return d.select("slug", "d", "change", "direction", subject.alias("subject"), body.alias("body"))
