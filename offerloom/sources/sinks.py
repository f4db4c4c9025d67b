"""Sinks (K1 to K4, K6, K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions.text import safe_part
from offerloom.operators.summary import canonical_summary
from offerloom.sources.scratch import new_path, remove, rename_parts

SPLITS = ("brand", "size", "model")


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """K1: replace or append to a catalog table."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode}")
    df.write.mode(mode).saveAsTable(name)


def save_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite") -> None:
    """K2."""
    df.write.mode(mode).option("compression", compression).parquet(path)


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: with header, UTF-8."""
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(path)


def save_partitioned(listings: DataFrame, path: str, split_by: list[str]) -> None:
    """K4: listings and their summary, each partitioned by path-safe values of ``split_by`` (of brand, size, model).

    The partition columns are named part_<column>; null and blank values become NA. Only partitions that are written are replaced.
    """
    if not split_by or not set(split_by) <= set(SPLITS):
        raise ValueError(f"split_by must name some of {SPLITS}")
    parts = [f"part_{c}" for c in split_by]
    for df, name in ((listings, "listings"), (canonical_summary(listings), "summary")):
        safe = df.withColumns({p: safe_part(F.col(c)) for p, c in zip(parts, split_by, strict=True)})
        safe.repartition(*parts, F.pmod(F.xxhash64("canonical_key"), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(f"{path}/{name}")


def save_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K6: one JSON record per row; nested columns stay nested."""
    df.write.mode(mode).json(path)


def save_snapshots(snapshots: DataFrame, path: str, top: int | None = None) -> None:
    """One JSON array for each (slug, d), named ``slug_YYYYMMDD.json``, or ``slug_topN_YYYYMMDD.json`` with its first ``top`` rows by price.

    A snapshot is what one search found on one day and is one file, so it is made in one task; the executors write the files, the driver
    only gives them their names. Slugs are made safe for paths.
    """
    rows = snapshots.withColumn("name_", F.concat_ws("_", safe_part(F.col("slug")), *([F.lit(f"top{top}")] if top else []), F.date_format("d", "yyyyMMdd")))
    fields = [c for c in snapshots.columns if c not in ("slug", "d")]
    found = F.array_sort(F.collect_list(F.struct(F.col("price").alias("sort_price"), *fields)))
    files = rows.groupBy("name_").agg((F.slice(found, 1, top) if top else found).alias("rows_"))
    text = files.select("name_", F.to_json(F.transform("rows_", lambda r: F.struct(*[r[c].alias(c) for c in fields]))).alias("value"))
    staging = new_path(snapshots.sparkSession, "snapshots")
    text.repartition("name_").write.partitionBy("name_").text(staging)
    rename_parts(snapshots.sparkSession, staging, path, ".json")
    remove(snapshots.sparkSession, staging)


def save_listing_files(listings: DataFrame, path: str, ceps: list[str] | None = None) -> None:
    """K7: the same rows as JSON and as CSV; in the CSV the map ``shipping`` becomes a column per wanted postcode, other maps JSON text."""
    listings.write.mode("overwrite").json(f"{path}/json")
    flat = listings
    if "shipping" in flat.columns:
        flat = flat.withColumns({f"shipping_{c}": F.try_element_at("shipping", F.lit(c)) for c in ceps or []}).drop("shipping")
    nested = {c: F.to_json(c) for c, t in flat.dtypes if t.startswith(("map", "struct", "array"))}
    save_csv(flat.withColumns(nested) if nested else flat, f"{path}/csv")
