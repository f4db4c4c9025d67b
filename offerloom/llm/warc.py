"""Not-modified revisits of a web archive: each gets the latest earlier full response of its URL, checked and merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from offerloom.llm.common import materialize

#: Headers that a 304 answer may renew (fixed values).
RENEWED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: F.Column) -> F.Column:
    """Scheme, ``www.``, fragment, utm_ parameters, default ports and a last slash left out; the host in lower case. Null stays null."""
    rest = F.regexp_replace(F.regexp_replace(url, "#[\\s\\S]*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.translate(F.regexp_extract(rest, "^([^/?]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), ":(80|443)$", ""), "^www\\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/$", "")
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, "(\\?[\\s\\S]*)$", 1), "utm_[a-z]+=[^&]*&?", ""), "[?&]$", "")
    return F.concat(host, path, query)


def resolve_revisits(records: DataFrame, rows_per_bucket: int = 100_000) -> DataFrame:
    """(rec_id, url_key, ts, response_id, validation, headers) for each revisit of ``records``.

    ``records`` has rec_id, url, ts (long), kind ('response' or 'revisit'), etag, last_modified (long) and headers (map, names in
    lower case). A revisit is joined to the response of the same canonical URL with the greatest (ts, rec_id) before its own.
    validation: 'etag' if both have an entity tag and they agree by weak comparison (a leading W/ doesn't count); else, if one lacks it, 'last_modified' if both have the time and
    the response's is not later; 'mismatch' if the validator that both have disagrees; 'unvalidated' if there is none;
    'unresolved' without an earlier response. headers of a validated revisit are the response's with the permitted ones (RENEWED)
    of the revisit in their place; else null.

    The as-of join is a window over (URL, time bucket); the last response of earlier buckets is carried over from a table with one
    row per URL and bucket. Buckets are ranges of time with about ``rows_per_bucket`` records each (Spark's range partitions, which
    follow a sample of the times), so a URL with a third of all records is split by time, however uneven its times are; only
    records of one instant stay together. Records without URL or time match nothing. Rows that repeat each get a row. An empty table gives
    an empty result. Extra columns are ignored.
    """
    r = records.select("rec_id", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("long").alias("ts"), "kind", "etag", F.col("last_modified").cast("long").alias("last_modified"), "headers")
    r = r.where("kind in ('response', 'revisit')")
    buckets = max(1, -(-r.count() // rows_per_bucket))
    if buckets > 1:
        r = r.repartitionByRange(buckets, "ts").withColumn("bucket", F.spark_partition_id())
    else:
        r = r.withColumn("bucket", F.lit(0))
    r = materialize(r, "records")
    full = F.when(F.col("kind") == "response", F.struct("ts", "rec_id", "etag", "last_modified", "headers"))
    usable = F.col("url_key").isNotNull() & F.col("ts").isNotNull()

    inside = Window.partitionBy("url_key", "bucket").orderBy("ts", "rec_id").rowsBetween(Window.unboundedPreceding, -1)
    within = r.where(usable).withColumn("found", F.last(full, ignorenulls=True).over(inside)).where("kind = 'revisit'")
    per_bucket = r.where(usable).groupBy("url_key", "bucket").agg(F.max_by(full, F.when(F.col("kind") == "response", F.struct("ts", "rec_id"))).alias("last"))
    earlier = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.withColumn("carried", F.last("last", ignorenulls=True).over(earlier)).where("carried is not null").select("url_key", "bucket", "carried")
    matched = within.join(carried, ["url_key", "bucket"], "left").withColumn("found", F.coalesce("found", "carried")).drop("carried")
    lost = r.where(~usable & (F.col("kind") == "revisit")).withColumn("found", F.lit(None).cast(matched.schema["found"].dataType))
    out = matched.unionByName(lost.select(*matched.columns))

    f = lambda c: F.col(f"found.{c}")
    weak = lambda c: F.regexp_replace(c, "^W/", "")
    tags, times = F.col("etag").isNotNull() & f("etag").isNotNull(), F.col("last_modified").isNotNull() & f("last_modified").isNotNull()
    validation = (
        F.when(F.col("found").isNull(), "unresolved")
        .when(tags, F.when(weak(F.col("etag")) == weak(f("etag")), "etag").otherwise("mismatch"))
        .when(times, F.when(f("last_modified") <= F.col("last_modified"), "last_modified").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    empty = F.from_json(F.lit("{}"), T.MapType(T.StringType(), T.StringType()))
    new = F.map_filter(F.coalesce("headers", empty), lambda k, v: k.isin(*RENEWED) & v.isNotNull())
    merged = F.map_concat(F.map_filter(F.coalesce(f("headers"), empty), lambda k, v: ~F.map_contains_key(new, k)), new)
    out = out.withColumn("validation", validation)
    return out.select("rec_id", "url_key", "ts", f("rec_id").alias("response_id"), "validation", F.when(F.col("validation").isin("etag", "last_modified"), merged).alias("headers"))


def header_text(headers: F.Column) -> F.Column:
    """A map of headers as ``name=value`` lines in order of their names."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat_ws("=", e["key"], e["value"]))), "\n")


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A capture history made of ``pages``: a full response of each page, and a later not-modified revisit of its URL.

    Page ids give the times. Entity tags are digests of the page; some revisits carry none and rely on the time, some an older tag.
    """
    p = pages.select(F.col("page_id").cast("long").alias("p"), "url", F.md5(F.coalesce("html", F.lit(""))).alias("d"))
    response = p.select(
        (2 * F.col("p")).alias("rec_id"), "url", (10 * F.col("p")).alias("ts"), F.lit("response").alias("kind"), F.col("d").alias("etag"), (10 * F.col("p") - F.col("p") % 7).alias("last_modified"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), F.col("d"), F.lit("date"), (10 * F.col("p")).cast("string"), F.lit("server"), F.lit("a")).alias("headers"),
    )
    ts = 10 * F.col("p") + 3 + 10 * ((F.col("p") * 7919) % 1000)
    tag = F.when(F.col("p") % 13 == 0, F.reverse("d")).when(F.col("p") % 11 == 0, F.lit(None)).otherwise(F.col("d"))
    revisit = p.select(
        (2 * F.col("p") + 1).alias("rec_id"), F.concat("url", F.lit("#again")).alias("url"), ts.alias("ts"), F.lit("revisit").alias("kind"), tag.alias("etag"), (10 * F.col("p") + 1).alias("last_modified"),
        F.create_map(F.lit("date"), ts.cast("string"), F.lit("cache-control"), F.concat(F.lit("max-age="), (F.col("p") % 5 * 60).cast("string")), F.lit("content-type"), F.lit("ignored"), F.lit("server"), F.lit("b")).alias("headers"),
    )
    return response.unionByName(revisit)


ORACLE = """
    WITH p AS (SELECT page_id AS p, url, md5(coalesce(html, '')) AS d, regexp_replace(regexp_replace(url, '#[\\s\\S]*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages),
    k AS (SELECT *, regexp_replace(regexp_replace(translate(regexp_extract(rest, '^([^/?]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)$', ''), '^www\\.', '')
           || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/$', '')
           || regexp_replace(regexp_replace(regexp_extract(rest, '(\\?[\\s\\S]*)$', 1), 'utm_[a-z]+=[^&]*&?', '', 'g'), '[?&]$', '') AS url_key FROM p),
    rs AS (SELECT 2 * p AS rec_id, url_key, 10 * p AS ts, d AS etag, 10 * p - p % 7 AS lm FROM k),
    rv AS (SELECT 2 * p + 1 AS rec_id, url_key, 10 * p + 3 + 10 * ((p * 7919) % 1000) AS ts, p,
           CASE WHEN p % 13 = 0 THEN reverse(d) WHEN p % 11 = 0 THEN NULL ELSE d END AS etag, 10 * p + 1 AS lm FROM k),
    j AS (SELECT rv.*, rs.rec_id AS response_id, rs.etag AS retag, rs.lm AS rlm FROM rv ASOF LEFT JOIN rs ON rv.url_key = rs.url_key AND rv.ts > rs.ts),
    v AS (SELECT *, CASE WHEN response_id IS NULL THEN 'unresolved' WHEN etag IS NOT NULL THEN CASE WHEN etag = retag THEN 'etag' ELSE 'mismatch' END
           WHEN rlm <= lm THEN 'last_modified' ELSE 'mismatch' END AS validation FROM j)
    SELECT rec_id, url_key, ts, response_id, validation, CASE WHEN validation IN ('etag', 'last_modified') THEN
           'cache-control=max-age=' || (p % 5 * 60)::VARCHAR || chr(10) || 'content-type=text/html' || chr(10) || 'date=' || ts::VARCHAR || chr(10) || 'etag=' || retag || chr(10) || 'server=a' END AS headers
    FROM v"""
