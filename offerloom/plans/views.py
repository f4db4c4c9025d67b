"""The registered queries' inputs, made of the given tables: marketplace listings, snapshots, series, internal data, decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTINGS = """
    SELECT lower(replace(r_name, ' ', '-')) AS marketplace,
      concat_ws(' ', p_name, p_brand, p_type, cast(p_size AS string)) AS title,
      l_extendedprice AS price,
      concat('https://www.', lower(replace(r_name, ' ', '-')), '.example.com/p/', cast(l_partkey AS string), '/', cast(l_suppkey AS string)) AS url,
      p_brand AS brand, p_type AS model, cast(p_size AS string) AS size,
      concat_ws('|', p_brand, cast(p_size AS string), p_type) AS canonical_key,
      l_shipdate AS collected_at, s_name AS seller,
      concat(lower(replace(r_name, ' ', '-')), '/data/raw/', cast(year(l_shipdate) AS string), '.csv') AS source_file,
      l_orderkey, l_partkey, l_suppkey, l_linenumber
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

#: Listings with holes: some fields are blank or null, some prices are not positive.
GAPPY = """
    SELECT CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE marketplace END AS marketplace,
      CASE WHEN l_partkey % 23 = 0 THEN ' ' ELSE title END AS title,
      CASE WHEN l_orderkey % 19 = 0 THEN -price WHEN l_orderkey % 29 = 0 THEN NULL ELSE price END AS price,
      CASE WHEN l_suppkey % 31 = 0 THEN '' ELSE url END AS url,
      CASE WHEN l_partkey % 7 = 0 THEN '' ELSE brand END AS brand,
      CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE model END AS model,
      CASE WHEN l_partkey % 13 = 0 THEN '' ELSE size END AS size,
      CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE canonical_key END AS canonical_key,
      CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE collected_at END AS collected_at,
      CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE seller END AS seller, source_file,
      l_orderkey, l_partkey, l_suppkey, l_linenumber
    FROM listings"""

SNAPSHOTS = """
    SELECT event_type AS slug, cast(ts AS date) AS d, cast(round(value, 2) AS double) AS price, user_id % 3 = 0 AS free_shipping, event_id FROM events"""

SERIES = """
    SELECT user_id AS product_id, round(value, 2) AS preco, ts AS data_coleta, event_id FROM events"""

INTERNAL = """
    SELECT p_partkey AS sku_key, round(p_retailprice * 0.6, 2) AS cost_price, cast(p_retailprice AS double) AS sale_price, cast(p_size AS double) AS stock FROM part"""

OFFERS_BY_DAY = """
    SELECT l_partkey AS sku_key, cast(l_shipdate AS date) AS date, cast(floor(l_extendedprice * 100 / l_quantity) AS double) / 100 AS price FROM lineitem"""

VIEWS = {"listings": LISTINGS, "gappy": GAPPY, "snapshots": SNAPSHOTS, "series": SERIES, "internal_data": INTERNAL, "offers_by_day": OFFERS_BY_DAY}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    body = text
    for name in frames:
        body = body.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
    return spark.sql(body, **frames)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, LISTINGS, **{t: table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation", "region")})


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, GAPPY, listings=listings(spark, sf_dir))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, SNAPSHOTS, events=table(spark, sf_dir, "events"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, SERIES, events=table(spark, sf_dir, "events"))


def internal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, INTERNAL, part=table(spark, sf_dir, "part"))


def offers_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, OFFERS_BY_DAY, lineitem=table(spark, sf_dir, "lineitem"))


def market_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gappy listings as ``market_items``: SKU from part, supplier and title, and the remaining columns."""
    g = gappy(spark, sf_dir)
    return g.select(
        F.lit("feed").alias("source"), "marketplace", F.concat(F.lit("p-"), F.col("l_partkey").cast("string"), F.lit("_20240101_000000.json")).alias("query"), "title",
        F.when(F.col("l_partkey") % 41 != 0, F.concat(F.lit("SKU "), F.col("l_partkey").cast("string"))).alias("sku_text"),
        F.when(F.col("l_partkey") % 41 != 0, F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string"))).alias("sku_norm"),
        "price", F.lit("BRL").alias("currency"), F.lit(None).cast("string").alias("condition"), "seller", "url", F.lit(None).cast("double").alias("shipping_price"),
        F.lit(None).cast("double").alias("stock"), F.lit(None).cast("string").alias("location"), F.col("collected_at").alias("captured_at"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    )


def with_views(sql: str, *names: str) -> str:
    """DuckDB SQL: ``sql`` with the named views before it."""
    order = [n for n in VIEWS if n in names or n == "listings" and "gappy" in names]
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in order) + ("," if sql.lstrip().upper().startswith("WITH") else "") + (sql.lstrip()[4:] if sql.lstrip().upper().startswith("WITH") else f" {sql}")
