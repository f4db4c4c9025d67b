"""Registered queries of sources, sinks and the ingest: tables are written to the shared folder and read back by the source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions import numbers as N
from offerloom.operators import summary
from offerloom.plans import views
from offerloom.plans.catalog import MEAN, ROW, query
from offerloom.plans.views import table
from offerloom.sources import files, sinks
from offerloom.sources.scratch import new_path
from offerloom.streaming.ingest import ingest_stream

PART = "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice"


def _typed(df: DataFrame) -> DataFrame:
    return df.select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", "p_brand", "p_type", F.coalesce(F.col("p_size").cast("int"), F.lit(0)).alias("p_size"), F.col("p_retailprice").cast("double").alias("p_retailprice"))


def _grouped_parts(spark, d, path: str) -> None:
    """One JSON file for each size, with the parts of that size in a wrapper object."""
    p = table(spark, d, "part").withColumn("folder", F.concat(F.lit("s"), F.col("p_size").cast("string")))
    wrapped = p.groupBy("folder").agg(F.sort_array(F.collect_list(F.struct(*PART.split(", ")))).alias("items"))
    wrapped.repartition("folder").write.partitionBy("folder").json(path)


@query("read_wrapped_json", f"SELECT {PART}, 'folder=s' || p_size AS folder FROM part")
def _(spark, d):
    _grouped_parts(spark, d, path := new_path(spark, "wrapped"))
    out = files.read_listings_json(spark, path, "items")
    return _typed(out).withColumn("folder", F.concat(F.lit("folder=s"), F.col("p_size").cast("string"))).where(out["source_file"].isNotNull())


@query("source_tags", "SELECT p_partkey, 'folder=s' || p_size AS tag FROM part")
def _(spark, d):
    _grouped_parts(spark, d, path := new_path(spark, "tagged"))
    rows = files.read_listings_json(spark, path, "items")
    tagged = files.with_source_tag(rows, path, tail=1, path=F.col("source_file"), name="tag")
    return tagged.select("p_partkey", F.regexp_extract("tag", "^[^/]+/(folder=[^/]+)/[^/]+$", 1).alias("tag"))


@query("roundtrip_jsonl", f"SELECT {PART} FROM part")
def _(spark, d):
    sinks.save_jsonl(table(spark, d, "part"), path := new_path(spark, "jsonl"))
    return _typed(files.read_listings_jsonl(spark, path))


@query("roundtrip_csv", f"SELECT {PART} FROM part UNION ALL SELECT s_suppkey, s_name, NULL, NULL, 0, NULL FROM supplier")
def _(spark, d):
    """Files of two headers below one folder."""
    path = new_path(spark, "csv")
    sinks.save_csv(table(spark, d, "part"), f"{path}/a")
    sinks.save_csv(table(spark, d, "supplier").select(F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("p_name")), f"{path}/b")
    return _typed(files.read_listings_csv(spark, path))


@query("roundtrip_folder", f"SELECT {PART} FROM part UNION ALL SELECT s_suppkey, s_name, NULL, NULL, 0, NULL FROM supplier")
def _(spark, d):
    path = new_path(spark, "folder")
    sinks.save_parquet(table(spark, d, "part"), f"{path}/a", compression="gzip")
    sinks.save_csv(table(spark, d, "supplier").select(F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("p_name")), f"{path}/b")
    return _typed(files.read_folder(spark, path, source="folder"))


@query("roundtrip_table", f"SELECT {PART} FROM part UNION ALL SELECT p_partkey + 1000000, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _(spark, d):
    """Replaced, appended to, and read in place of an empty table."""
    path = new_path(spark, "tables")
    db = "offerloom_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{path}'")
    p = table(spark, d, "part")
    sinks.save_table(p.limit(0), f"{db}.empty")
    sinks.save_table(p.limit(1), f"{db}.parts")
    sinks.save_table(p, f"{db}.parts")
    sinks.save_table(p.withColumn("p_partkey", F.col("p_partkey") + 1_000_000), f"{db}.parts", mode="append")
    return files.read_table(spark, f"{db}.empty", fallback=f"{db}.parts").select(*PART.split(", "))


@query("roundtrip_partitioned", f"SELECT {ROW}, regexp_replace(brand, '[^a-zA-Z0-9_.=-]+', '-', 'g') AS part_brand, size AS part_size FROM listings WHERE brand <> '' UNION ALL SELECT {ROW}, 'NA', coalesce(nullif(size, ''), 'NA') FROM gappy WHERE brand = ''", "listings", "gappy")
def _(spark, d):
    both = views.listings(spark, d).unionByName(views.gappy(spark, d).where("brand = ''"))
    sinks.save_partitioned(both, path := new_path(spark, "partitioned"), ["brand", "size"])
    return spark.read.parquet(f"{path}/listings").select(*ROW.split(", "), F.col("part_brand").cast("string").alias("part_brand"), F.col("part_size").cast("string").alias("part_size"))


@query("partitioned_summary", f"SELECT regexp_replace(brand, '[^a-zA-Z0-9_.=-]+', '-', 'g') AS part_brand, canonical_key, count(*) AS n_listings, {MEAN} AS mean_price FROM listings GROUP BY ALL", "listings")
def _(spark, d):
    sinks.save_partitioned(views.listings(spark, d), path := new_path(spark, "partitioned"), ["brand"])
    return spark.read.parquet(f"{path}/summary").select("part_brand", "canonical_key", "n_listings", "mean_price")


@query("roundtrip_listing_files", "SELECT p_partkey, p_name, p_retailprice AS shipping_01, NULL::DOUBLE AS shipping_02 FROM part WHERE p_size < 25 UNION ALL SELECT p_partkey, p_name, NULL, p_retailprice FROM part WHERE p_size >= 25")
def _(spark, d):
    """Shipping costs by postcode, as a map in the JSON files and a column each in the CSV files; both are read and compared."""
    p = table(spark, d, "part")
    rows = p.select("p_partkey", "p_name", F.create_map(F.when(F.col("p_size") < 25, "01").otherwise("02"), F.col("p_retailprice")).alias("shipping"))
    sinks.save_listing_files(rows, path := new_path(spark, "listing"), ["01", "02"])
    cost = lambda c: F.col(c).cast("double").alias(c)
    of_csv = files.read_listings_csv(spark, f"{path}/csv").select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", cost("shipping_01"), cost("shipping_02"))
    of_json = files.read_listings_jsonl(spark, f"{path}/json", schema="p_partkey long, p_name string, shipping map<string,double>")
    of_json = of_json.select("p_partkey", "p_name", F.try_element_at("shipping", F.lit("01")).alias("shipping_01"), F.try_element_at("shipping", F.lit("02")).alias("shipping_02"))
    return of_csv.intersectAll(of_json)


@query("path_meta", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'magalu' WHEN 1 THEN 'mercadolivre' ELSE 'pneustore' END AS marketplace, 'item_' || p_partkey || '_2025' || lpad((1 + p_size % 12)::VARCHAR, 2, '0') || '07_101500.json' AS query, '2025-' || lpad((1 + p_size % 12)::VARCHAR, 2, '0') || '-07 10:15:00' AS captured_at FROM part")
def _(spark, d):
    k = F.col("p_partkey") % 3
    folder = F.when(k == 0, "/a/data/raw/MagazineLuiza/").when(k == 1, "/a/mercado_livre/raw/x/").otherwise("C:\\pneu_store\\raw\\y\\")
    name = F.concat(F.lit("item_"), F.col("p_partkey").cast("string"), F.lit("_2025"), F.lpad((1 + F.col("p_size") % 12).cast("string"), 2, "0"), F.lit("07_101500.json"))
    m = table(spark, d, "part").select("p_partkey", files.meta_from_path(F.concat(folder, name)).alias("m"))
    return m.select("p_partkey", "m.marketplace", "m.query", N.ts_text(F.col("m.captured_at")).alias("captured_at"))


@query("run_reports", f"SELECT brand AS termo, count(*) AS produtos_encontrados, count(*) FILTER (l_linenumber = 1) AS promocoes, round({MEAN}, 2) AS preco_medio, least(count(*), 20) AS listed FROM listings GROUP BY 1", "listings")
def _(spark, d):
    """One report file for each term, read back as runs and products."""
    hits = views.listings(spark, d).select(F.col("brand").alias("term"), "title", "price", "url", (F.col("l_linenumber") == 1).alias("promo"))
    reports = summary.search_run_report(hits, 20).withColumnRenamed("term", "termo")
    reports.withColumn("folder", F.xxhash64("termo")).repartition("folder").write.partitionBy("folder").json(path := new_path(spark, "reports"))
    runs, products = files.read_run_reports(spark, path, "*.json")
    return runs.join(products.groupBy("termo").agg(F.count(F.lit(1)).alias("listed")), "termo").select("termo", "produtos_encontrados", "promocoes", "preco_medio", "listed")


@query("new_files", "SELECT p_partkey FROM part WHERE p_size >= 10")
def _(spark, d):
    """Files of small sizes are in the state already."""
    _grouped_parts(spark, d, path := new_path(spark, "state"))
    rows = spark.read.option("recursiveFileLookup", True).schema("items array<struct<p_partkey:long,p_size:int>>").json(path)
    none = spark.createDataFrame([], "table_name string, source_id string, ts timestamp")
    first = rows.where("items[0].p_size < 10")
    _, seen = files.new_files_only(first, none, "parts")
    fresh, _ = files.new_files_only(rows, seen, "parts")
    return fresh.select(F.inline("items")).select("p_partkey")


@query("ingest", "SELECT p_partkey, upper(p_name) AS p_name, p_size FROM part")
def _(spark, d):
    """Two runs of the ingest over a folder that grows in between: every file is read once."""
    path, p = new_path(spark, "ingest"), table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    for k, condition in enumerate(("p_size < 20", "p_size >= 20")):
        p.where(condition).write.mode("append").json(f"{path}/in")
        run = ingest_stream(spark, f"{path}/in", "p_partkey long, p_name string, p_size int", f"{path}/out", f"{path}/checkpoint", lambda b: b.withColumn("p_name", F.upper("p_name")), multi_line=False, files_per_batch=2 + k)
        run.awaitTermination()
    return spark.read.parquet(f"{path}/out").select("p_partkey", "p_name", "p_size")


@query("read_snapshots", "SELECT slug, cast(d AS VARCHAR) AS d, price, event_id FROM snapshots", "snapshots")
def _(spark, d):
    """One file a slug and day, whose name alone tells both."""
    path = new_path(spark, "named")
    sinks.save_snapshots(views.snapshots(spark, d).select("slug", "d", "price", "event_id"), path)
    out = files.read_snapshots(spark, path, top10_only=False, schema="price double, event_id long")
    return out.select("slug", F.col("d").cast("string").alias("d"), "price", "event_id")


@query("read_top10_snapshots", "SELECT slug, cast(d AS VARCHAR) AS d, price, event_id FROM snapshots QUALIFY row_number() OVER (PARTITION BY slug, d ORDER BY price, event_id) <= 10", "snapshots")
def _(spark, d):
    path = new_path(spark, "top10")
    sinks.save_snapshots(views.snapshots(spark, d).select("slug", "d", "price", "event_id"), path, top=10)
    out = files.read_snapshots(spark, path, schema="price double, event_id long")
    return out.select("slug", F.col("d").cast("string").alias("d"), "price", "event_id")
