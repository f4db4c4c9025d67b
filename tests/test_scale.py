"""Steps that are worked out once, or on few rows, whatever the size of the input."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from offerloom.config import DEFAULT
from offerloom.functions import numbers as N
from offerloom.llm import embedding_dedup
from offerloom.operators import audit, dedup, listings, pricing, quality, summary
from offerloom.plans import catalog, composites  # noqa: F401


def test_shipping_words_stand_alone(spark):
    df = spark.createDataFrame([("laenvioipa ment 40",), ("Frete: R$ 12,90",), ("fretes 7",), ("Envío 3,5",)], "t string")
    assert [r.c for r in df.select(N.free_shipping(F.col("t"))["cost"].alias("c")).collect()] == [None, 12.9, 7.0, 3.5]


ROWS = [(f"k{i % 3}", "b", "m", "s", f"t{i % 5}", float(i), f"u{i}", f"s{i % 2}", "mk", "f") for i in range(60)]
SCHEMA = "canonical_key string, brand string, model string, size string, title string, price double, url string, seller string, marketplace string, source_file string"


def read(df) -> set[str]:
    """The names of the written tables that a frame reads."""
    return {f.rsplit("/", 2)[1].split("-")[0] for f in df.inputFiles()}


def test_audit_sample_reads_written_groups(spark):
    """The summary is worked out once, not for each of its uses."""
    x = spark.createDataFrame(ROWS, SCHEMA)
    out = audit.audit_sample(summary.canonical_summary(x), x)
    assert read(out) == {"groups", "sample", "wanted"} and out.count() == 3


def test_summary_reads_listings_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    summary.canonical_summary(spark.createDataFrame(ROWS, SCHEMA).mapInArrow(rows, SCHEMA)).collect()
    assert seen.value == len(ROWS)


def test_final_sections(spark):
    """Only the wanted reports are worked out."""
    x = spark.createDataFrame(ROWS, SCHEMA)
    s = summary.canonical_summary(x)
    marks = s.select("canonical_key", F.lit(True).alias("llm_ok"), F.lit(1.0).alias("llm_confidence"), F.array().cast("array<string>").alias("precheck_alerts"))
    out = audit.generate_final(x, s, marks, sections=("counts",))
    assert list(out) == ["counts"] and out["counts"].first().kept == 60


def test_pages_are_spread(spark, tmp_path):
    """Pages made of a small file are more than one task."""
    spark.createDataFrame([(k, f"part {k}", k % 50, 900.0 + k) for k in range(9)], "p_partkey long, p_name string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for name in ("extract_pages", "extract_page_products"):
        assert "REPARTITION_BY_NUM" in catalog.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().toString()


def test_evidence_titles_once(spark):
    """Attributes come from the distinct titles of the written evidence; fields inside the JSON text as before."""
    rows = [("u1", '{"titulo": "pneu Pirelli P1 205/55R16", "loja": "s"}'), ("u2", '{"titulo": "pneu Pirelli P1 205/55R16", "marca": " ", "brand_raw": "X", "modelo": 7}'), ("u3", "{broken"), ("u4", None)]
    out = quality.evidence_values(spark.createDataFrame(rows, "url string, payload string"), "payload", DEFAULT)
    assert read(out) == {"evidence"}
    got = {r.url: (r.seller, r.brand, r.model, r.size) for r in out.collect()}
    assert got["u1"][0] == "s" and got["u1"][1] == "pirelli" and got["u1"][3] == "205/55R16"
    assert got["u2"][:3] == (None, "X", "7") and got["u3"][0] is None and got["u4"][1:] == (None, None, None)


def test_rows_alone_are_not_shuffled(spark):
    """Only rows that share a key go through the window; with too many shared keys all rows do, with the same result."""
    df = spark.range(300).select((F.col("id") % 290).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"), F.lit("x").alias("h_"))
    key = lambda d: sorted(map(str, d.collect()))
    few = dedup.keep_first_of_few(df, ["k"], [F.col("v").desc_nulls_last()])
    assert read(few) == {"rows", "repeated"} and few.columns == df.columns
    assert key(few) == key(dedup.keep_first_of_few(df, ["k"], [F.col("v").desc_nulls_last()], most=5)) == key(dedup.keep_first_by(df, ["k"], [F.col("v").desc_nulls_last()]))


def test_discards_remove_no_copies(spark):
    rows = [("m", None, "t", None, 1.0, "u", None), ("m", None, "t", None, 0.0, "u", None)]
    items = spark.createDataFrame(rows, "marketplace string, query string, title string, sku_norm string, price double, url string, captured_at timestamp")
    out = listings.clean_market_items(items, ("discards",))
    assert list(out) == ["discards"] and [r.reason for r in out["discards"].collect()] == ["bad_price"]


def test_bundles_of_tiles():
    """A tile is sent at most 16 times, as long as bundles have their room, and there are bundles enough for many tasks."""
    for n in (1, 15, 16, 50, 128, 600, 1024):
        bundles = -(-n // embedding_dedup.tiles_together(n, 2 << 20))
        assert bundles <= 16 and (n < 16 or bundles > 8)


def offers(spark, n, distinct):
    """``n`` training rows of ``distinct`` feature vectors, with labels that differ inside a vector."""
    v = F.col("id") % distinct
    df = spark.range(n).select(F.col("id").alias("sku_key"), *[((v * k * k) % (distinct + k)).cast("double").alias(c) for k, c in enumerate(pricing.FEATURES, 1)], (F.col("id") % 4).cast("double").alias("noise"))
    return df.select("*", (F.col("cost_price") * 2 + F.col("stock") % 7 + F.col("noise")).alias("label")).withColumn("sale_price", F.col("label"))


def fitted(spark, monkeypatch, *args, **kwargs):
    """A trained model and the number of rows that its rounds read."""
    rows, fit = [], pricing.GBTRegressor.fit
    with monkeypatch.context() as m:
        m.setattr(pricing.GBTRegressor, "fit", lambda self, df: rows.append(df.count()) or fit(self, df))
        return pricing.train_price_model(*args, **kwargs)[0], rows[0]


def test_price_model_reads_vectors(spark, monkeypatch):
    """Rows of one feature vector are one row of the fit, and the predictions those of a fit of all rows."""
    table = offers(spark, 2000, 60).cache()
    model, n = fitted(spark, monkeypatch, table, rounds=5, step=0.5)
    assert n == 60
    whole = Pipeline(stages=[VectorAssembler(inputCols=list(pricing.FEATURES), outputCol="features"), GBTRegressor(maxIter=5, stepSize=0.5, seed=42)]).fit(pricing.split_rows(table)[0])
    got, want = ({r.sku_key: r.prediction for r in m.transform(table).select("sku_key", "prediction").collect()} for m in (model, whole))
    assert len(got) == 2000 and max(abs(got[k] - want[k]) for k in want) < 1e-6


def test_price_model_reads_bins(spark, monkeypatch):
    """Of many vectors, those of the same bins are one row of the fit, which is as good as one of all rows, also with scaled features."""
    table = offers(spark, 6000, 3000).withColumns({c: F.col("cost_price") + F.col("sku_key") % 5 / 10 for c in pricing.FEATURES[2:]}).cache()
    error = lambda m: summary.regression_metrics(m.transform(pricing.split_rows(table)[1])).first().rmse
    (bins, few), (vectors, n) = (fitted(spark, monkeypatch, table, rounds=5, step=0.5, most_vectors=k) for k in (100, 10_000))
    assert few < n / 2 and 0.9 < error(bins) / error(vectors) < 1.1
    assert not any(" in {" in t.toDebugString for t in bins.stages[-1].trees)  # bins are numbers, so trees cut them in order
    scaled, _ = fitted(spark, monkeypatch, table, rounds=5, step=0.5, most_vectors=100, scale=True)
    assert 0.95 < error(scaled) / error(bins) < 1.05


def test_price_model_refuses_missing_labels(spark):
    table = offers(spark, 200, 20).withColumn("label", F.when(F.col("sku_key") != 7, F.col("label")))
    with pytest.raises(Exception, match="(?i)label"):
        pricing.train_price_model(table.union(table.withColumn("sku_key", F.col("sku_key") + 1000)), rounds=1)


def test_percentiles_of_the_latest_day_only(spark):
    """Only offers of the latest day of each SKU are summarised; SKUs without any day keep theirs."""
    x = spark.createDataFrame([(1, "2024-01-01", 5.0), (1, "2024-01-02", 7.0), (1, "2024-01-02", 9.0), (1, None, 1.0), (2, None, 3.0), (2, None, 4.0)], "sku_key int, date string, price double")
    latest = dedup.rows_of_latest(x, "sku_key", "date")
    assert sorted((r.sku_key, r.price) for r in latest.collect()) == [(1, 7.0), (1, 9.0), (2, 3.0), (2, 4.0)]
    got, want = (dedup.latest_per_key(summary.aggregates_daily(d), "sku_key", "date").collect() for d in (latest, x))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_price_model_error_makes_its_table_once(spark, monkeypatch):
    made = []
    table = offers(spark, 300, 40)
    monkeypatch.setattr(catalog, "_training", lambda *_: made.append(1) or table)
    full = pricing.train_price_model
    monkeypatch.setattr(pricing, "train_price_model", lambda t: full(t, rounds=2))
    for name in ("price_model_error", "suggest_ml"):
        assert not catalog.QUERIES[name](spark, "made").isEmpty()
    catalog._MODELS.clear()
    assert len(made) == 2


def test_quantiles_of_small_and_large_groups_are_joined(spark, monkeypatch):
    """A union of two parts that are dealt out alike passed for one table dealt out like these, and the join with it failed."""
    price = F.when(F.col("id") % 40 < 20, F.col("id") + 0.25).otherwise(F.col("id") % 100 + 0.5)
    x = spark.range(20_000).select((F.col("id") % 40).cast("string").alias("canonical_key"), *[F.lit(c[0]).alias(c) for c in ("brand", "model", "size", "marketplace", "source_file")], price.alias("price"))
    want = sorted(map(str, summary.canonical_summary(x).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts, of = [], summary.quantiles_of_counts
        monkeypatch.setattr(summary, "MOST_PRICES", 499, raising=False)
        monkeypatch.setattr(summary, "quantiles_of_counts", lambda c, at: parts.append(c.select("k").distinct().count()) or of(c, at, 300))
        assert sorted(map(str, summary.canonical_summary(x).collect())) == want and parts == [40]
        mixed = x.where("canonical_key < '2' OR price > 90")  # only some groups have more prices than that
        got = sorted(map(str, summary.canonical_summary(mixed).collect()))
        monkeypatch.setattr(summary, "MOST_PRICES", 10**6)
        assert got == sorted(map(str, summary.canonical_summary(mixed).collect())) and 0 < parts[1] < 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
