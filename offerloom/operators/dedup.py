"""Duplicate removal and latest-row operators (W1 to W5, W11, W12) and upserts (K5).

"First" and "last" always follow an explicit order, with all columns as tie-breakers, so results don't depend on partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerloom.functions.names import fresh
from offerloom.functions.text import norm_txt_ws, url_norm
from offerloom.sources.scratch import written


def _tie_break(df: DataFrame, taken: set[str]) -> list[Column]:
    """Every sortable column that isn't ordered by yet."""
    return [F.col(f"`{c}`").asc_nulls_last() for c, t in df.dtypes if c not in taken and not t.startswith(("map", "variant"))]


def keep_first_by(df: DataFrame, keys: list[str | Column], order: list[Column] | None = None) -> DataFrame:
    """Of each key the first row in ``order``, then by all columns.

    Each task passes on one row of a key, so a key that holds a third of all rows is a row a task. Rows sort by a hash of the key first:
    one number decides nearly every comparison, and the columns only those between rows of one key.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    w = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*(order or []), *_tie_break(df, set()))
    (rank,) = fresh(df, "rn_")
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)


def keep_first_of_few(df: DataFrame, keys: list[str | Column], order: list[Column] | None = None, stored: bool = False, most: int = 1 << 22) -> DataFrame:
    """W12 for keys that few rows share: rows alone with their key stay where they are, and only the others are shuffled and sorted.

    ``df`` is written, unless it is ``stored`` already. Hashes of the keys are counted; those that occur more than once are broadcast, if
    they are at most ``most`` (eight bytes each). With more of them all rows go the way of :func:`keep_first_by`.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    df = df if stored else written(df, "rows")
    (h,) = fresh(df, "h_")
    d = df.withColumn(h, F.xxhash64(*keys))
    repeated = written(d.groupBy(h).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(h), "repeated")
    if repeated.count() > most:
        return keep_first_by(df, keys, order)
    repeated = F.broadcast(repeated)
    alone, others = d.join(repeated, h, "left_anti"), d.join(repeated, h, "left_semi")
    return alone.drop(h).unionByName(keep_first_by(others.drop(h), keys, order))


def dedup_offers(df: DataFrame, stored: bool = False) -> DataFrame:
    """The newest row of each (marketplace, url) stays, then of each (marketplace, title, price); so exact copies go too.

    Rows without a url are no copies of each other: in the first step each is a group of its own, by a hash of the whole row.
    ``df`` is written, unless it is ``stored`` already.
    """
    newest = [F.col("captured_at").desc_nulls_last(), F.col("url").desc_nulls_last()]
    url = _has("url")
    groups = [F.col("marketplace"), F.when(url, F.col("url")), F.when(~url, F.xxhash64(*_hashable(df)))]
    return keep_first_by(keep_first_of_few(df, groups, newest, stored), ["marketplace", "title", "price"], newest)


def latest_snapshot(df: DataFrame) -> DataFrame:
    """The newest row of each (marketplace, sku_norm); rows without SKU or time drop out."""
    return keep_first_by(df.where("sku_norm IS NOT NULL AND captured_at IS NOT NULL"), ["marketplace", "sku_norm"], [F.col("captured_at").desc()])


def latest_per_key(df: DataFrame, key: str, date: str) -> DataFrame:
    """The row with the latest date of each key."""
    return keep_first_by(df, [key], [F.col(date).desc_nulls_last()])


def rows_of_latest(df: DataFrame, key: str, date: str) -> DataFrame:
    """All rows of the latest date of each key; each task passes on only those of the latest date it has seen."""
    (rank,) = fresh(df, "rank_")
    return df.withColumn(rank, F.rank().over(Window.partitionBy(key).orderBy(F.col(date).desc_nulls_last()))).where(F.col(rank) == 1).drop(rank)


def _hashable(df: DataFrame) -> list[Column]:
    return [F.to_json(F.col(f"`{c}`")) if "map" in t else F.col(f"`{c}`") for c, t in df.dtypes]


def _has(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(F.col(c)) != "")


def dedup_listing(df: DataFrame, within: list[str] | None = None, stored: bool = False) -> DataFrame:
    """One row of each (marketplace, url, seller, time, price), or without url of each (marketplace, seller, title, price, source).

    Rows that differ in the columns ``within`` are no copies. ``df`` is written, unless it is ``stored`` already.
    """
    url = _has("url")
    part = lambda c: F.when(url, F.col(c))
    rest = lambda c: F.when(~url, F.col(c))
    keys = [*map(F.col, within or []), F.col("marketplace"), F.col("seller"), F.col("price"), part("url"), part("collected_at"), rest("title"), rest("source_file")]
    return keep_first_of_few(df, keys, [F.col("source_file").asc_nulls_last()], stored)


def dedup_global(df: DataFrame, stored: bool = False) -> DataFrame:
    """As W4 over all sources: urls without fragment and case, the date for the time, texts folded; null key parts match nulls."""
    url = _has("url")
    keys = [
        norm_txt_ws(F.col("marketplace")), norm_txt_ws(F.col("seller")), F.coalesce("price", F.lit(-1.0)),
        F.when(url, url_norm(F.col("url"))), F.when(url, F.to_date("collected_at")), F.when(~url, norm_txt_ws(F.col("title"))),
    ]
    return keep_first_of_few(df, keys, [F.col("source_file").asc_nulls_last()], stored)


def recency_check(df: DataFrame) -> DataFrame:
    """Rows that are older than the newest of their (marketplace, sku_norm)."""
    w = Window.partitionBy("marketplace", "sku_norm")
    return df.withColumn("newest", F.max("captured_at").over(w)).where("captured_at < newest")


def upsert_by_key(target: DataFrame, updates: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """K5: target rows, replaced by the update with the same key or joined by new ones; of several updates the first in ``order``."""
    new = keep_first_by(updates, keys, order)
    matches = F.lit(True)
    for k in keys:
        matches = matches & target[k].eqNullSafe(new[k])
    return target.join(new.select(*keys), matches, "left_anti").unionByName(new, allowMissingColumns=True)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create_upsert_table(df: DataFrame, path: str, keys: list[str], buckets: int = 256) -> None:
    """K5: a table that :func:`upsert_table` can update: files by the bucket of their keys, and version 0 in its manifest."""
    bucketed = df.withColumn("bucket_", _bucket(keys, buckets))
    bucketed.repartition("bucket_").write.mode("overwrite").partitionBy("bucket_").parquet(f"{path}/rows")
    _note(df.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket_")), path, 0, buckets, "overwrite")


def _note(changed: DataFrame, path: str, version: int, buckets: int, mode: str = "append") -> None:
    changed.select(F.lit(version).alias("version"), F.lit(buckets).alias("buckets"), "bucket_").coalesce(1).write.mode(mode).parquet(f"{path}/manifest")


def read_upsert_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of such a table."""
    return spark.read.parquet(f"{path}/rows").drop("bucket_")


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], order: list[Column] | None = None) -> int:
    """K5: :func:`upsert_by_key` on a stored table; returns the new version.

    Only buckets that an update's key falls into are read and replaced; the files of all others stay as they are. The new rows are
    written beside the table first, so a failure before the replacement leaves it as it was, and one during it is mended by running the
    same update again. The manifest lists the buckets that each version replaced. New columns of the updates are null in older rows.
    """
    last = spark.read.parquet(f"{path}/manifest").agg(F.max("version").alias("version"), F.max("buckets").alias("buckets")).first()
    new = written(updates.withColumn("bucket_", _bucket(keys, last.buckets)), "updates")
    changed = written(new.select("bucket_").distinct(), "changed")
    touched = [r.bucket_ for r in changed.collect()]  # one number a bucket at most
    old = spark.read.parquet(f"{path}/rows").where(F.col("bucket_").isin(touched))
    merged = written(upsert_by_key(old.drop("bucket_"), new.drop("bucket_"), keys, order).withColumn("bucket_", _bucket(keys, last.buckets)), "merged")
    merged.repartition("bucket_").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket_").parquet(f"{path}/rows")
    _note(changed, path, last.version + 1, last.buckets)
    return last.version + 1
