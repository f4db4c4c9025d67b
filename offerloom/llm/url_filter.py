"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for the URLs that no rule fits."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import join_by_frequency, materialize, strata

#: (verdict, rule): a host, and the path from its first slash.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "params", "query_length", "fragment", "host_entropy", "path_entropy", "longest_label", "www", "suffix_share", "suffix_block", "segment_share", "segment_block")


def url_parts(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z in lower case) and path; both empty for null and for URLs without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_match(host: F.Column, path: F.Column, rules=RULES) -> F.Column:
    """The longest rule whose host is the URL's or a parent of it and whose path starts the URL's; a struct (verdict, rule) or null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def entropy(text: F.Column) -> F.Column:
    """Bits per character of a string's own character counts; 0 for the empty string."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.when(n > 0, F.aggregate(chars, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))).otherwise(F.lit(0.0))


def lexical_features(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """Add the lexical FEATURES (all but the statistics) and ``suffix``, the last two labels of the host."""
    u = F.coalesce(F.col(url), F.lit(""))
    h, p = F.col(host), F.col(path)
    labels = F.split(h, "\\.")
    query = F.regexp_extract(u, "\\?([^#]*)", 1)
    return df.withColumns({
        "length": F.length(u),
        "host_length": F.length(h),
        "path_length": F.length(p),
        "depth": F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit(""))),
        "labels": F.size(labels),
        "digit_ratio": F.length(F.regexp_replace(u, "[^0-9]", "")) / F.greatest(F.length(u), F.lit(1)),
        "hyphens": F.length(F.regexp_replace(u, "[^-_]", "")),
        "params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "query_length": F.length(query),
        "fragment": F.contains(u, F.lit("#")).cast("int"),
        "host_entropy": entropy(h),
        "path_entropy": entropy(p),
        "longest_label": F.array_max(F.transform(labels, F.length)),
        "www": F.startswith(h, F.lit("www.")).cast("int"),
        "suffix": F.array_join(F.slice(F.concat(F.array(F.lit(""), F.lit("")), labels), -2, 2), "."),
    })


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, most_train: int = 20_000, rounds: int = 15, depth: int = 4, held_out: F.Column | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages``.

    A rule's verdict stands. URLs without a rule get the verdict of boosted trees that are trained on URLs which a rule labels, on at
    most ``most_train`` of them, drawn by verdict in order of a hash and weighted to the numbers of all; ``held_out`` (a condition on
    page_id, url, host and path) keeps rows out of the training, so that their scores can be measured. score is the trees' probability
    of block, for all URLs. Statistics of a suffix (the last two labels of the host) and of the first segment of the path: their share
    among all URLs, and the smoothed share of block among all their labelled ones but the URL itself.

    Null URLs and URLs without ``://`` have an empty host and path and fit no rule. If the labelled URLs are all of one kind or there
    are none, the trees can't be trained: score is null and URLs without a rule are allowed. Rows that repeat each get a row. An
    empty table gives an empty result. Extra columns are ignored.
    """
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = url_parts(F.col("url"))
    base = base.withColumns({"host": host, "path": path}).withColumn("match", rule_match(F.col("host"), F.col("path"), rules))
    label = F.when(F.col("match").isNotNull() & ~F.coalesce(F.lit(False) if held_out is None else held_out, F.lit(False)), (F.col("match.verdict") == "block").cast("double"))
    rows = lexical_features(base.withColumn("label", label), "url", "host", "path")
    rows = materialize(rows.withColumn("segment", F.regexp_extract("path", "^/([^/]*)", 1)), "urls")

    n = {int(r.label): r.n for r in rows.where("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    total, rate = rows.count(), n1 / max(1, n0 + n1)
    for key in ("suffix", "segment"):
        stats = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_"), F.count("label").alias("known_"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked_"))
        stats = materialize(stats.withColumn(f"{key}_share", F.col("n_") / F.lit(max(1, total))), key)
        own = F.coalesce("label", F.lit(0.0))
        block = (F.col("blocked_") - own + 5 * F.lit(rate)) / (F.col("known_") - F.col("label").isNotNull().cast("int") + 5)
        rows = join_by_frequency(rows, stats, key, "n_").withColumn(f"{key}_block", block).drop("known_", "blocked_")
    rows = materialize(rows, "features")
    of = [rows.where(F.col("label") == t).orderBy(F.xxhash64("url"), "page_id").limit(k).withColumn("weight", F.lit(n.get(t, 0) / max(1, k))) for t, k in enumerate(strata(n0, n1, most_train))]

    verdict = F.coalesce("match.verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    if not (n0 and n1):
        scored = rows.withColumn("score", F.lit(None).cast("double"))
    else:
        to_vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        train = materialize(to_vector.transform(of[0].unionByName(of[1])).select("features", "label", "weight"), "labelled").coalesce(2)
        trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7, checkpointInterval=-1, weightCol="weight").fit(train)
        scored = trees.transform(to_vector.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("page_id", "host", "path", F.col("match.rule").alias("rule"), verdict.alias("verdict"), "score")
