"""The queries of the corpus operators: one ``opN_<name>`` for each, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm import divergence, license_scan, vector_codes, warc
from offerloom.llm.common import small_batches

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerloom.llm.exact_dedup import exact_dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digests = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return exact_dedup(digests).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerloom.llm.pii import find_pii

    return find_pii(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerloom.llm.url_filter import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op3 that SQL can express."""
    return op3_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule")


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(warc.records_of_pages(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", warc.header_text(F.col("headers")))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerloom.llm.ngram_join import jaccard_components

    small_batches(spark)
    return jaccard_components(table(spark, sf_dir, "documents"), width=5, percent=80)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerloom.llm.license_scan import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "canonical_sha256", "license", "notices")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerloom.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents"), cap=0.25)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerloom.llm.toxicity import score_toxicity

    small_batches(spark)
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerloom.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerloom.llm.embedding_dedup import embedding_near_copies

    return embedding_near_copies(table(spark, sf_dir, "embeddings"), threshold=0.9)


def embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10 on the given vectors beside a longer, a moved and a turned copy of each, so that each has links; small enough for all pairs in SQL at small scale."""
    from offerloom.llm.embedding_dedup import embedding_near_copies

    v = F.transform("embedding", lambda x: x.cast("double"))
    moved = F.transform(v, lambda x, i: F.when(i == 0, x + 0.25).otherwise(x))
    copies = F.array(v, F.transform(v, lambda x: x * 3), moved, F.transform(v, lambda x: -x))
    every = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(copies).alias("k", "embedding")).select((F.col("vec_id") * 4 + F.col("k")).alias("vec_id"), "embedding")
    return embedding_near_copies(every, threshold=0.9).select("vec_id", "n_links", "component_id", "kept")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerloom.llm.quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_bootstrapped_pii": op2_bootstrapped_pii,
    "op3_url_filter": op3_url_filter,
    "op4_warc_revisits": op4_warc_revisits,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_license_scan": op6_license_scan,
    "op7_source_mixing": op7_source_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_vector_codes": op13_vector_codes,
    "url_rules": url_rules,
    "embedding_links": embedding_links,
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op4_warc_revisits": warc.ORACLE,
    "url_rules": """
        WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
             p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r)
        SELECT page_id, host, path, CASE WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/' WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
               WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM p""",
    "op6_license_scan": license_scan.oracle(),
    "op11_source_divergence": divergence.ORACLE,
    "embedding_links": """
        WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
        c AS (SELECT vec_id * 4 AS i, v FROM e UNION ALL SELECT vec_id * 4 + 1, list_transform(v, lambda x: x * 3) FROM e
            UNION ALL SELECT vec_id * 4 + 2, list_concat([v[1] + 0.25], v[2:]) FROM e UNION ALL SELECT vec_id * 4 + 3, list_transform(v, lambda x: -x) FROM e),
        u AS MATERIALIZED (SELECT i, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM c),
        l AS MATERIALIZED (SELECT a.i, b.i AS j FROM u a, u b WHERE a.i <> b.i AND a.n > 0 AND b.n > 0 AND list_dot_product(a.v, b.v) >= 0.9 * a.n * b.n),
        r(i, j) AS (SELECT i, i FROM u UNION SELECT r.i, l.j FROM r JOIN l ON r.j = l.i),
        k AS (SELECT i, min(j) AS component_id FROM r GROUP BY i), m AS (SELECT i, count(*) AS n FROM l GROUP BY i)
        SELECT i AS vec_id, coalesce(m.n, 0) AS n_links, component_id, i = component_id AS kept FROM k LEFT JOIN m USING (i)""",
    "op13_vector_codes": vector_codes.oracle(),
}
