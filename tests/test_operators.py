"""Operators, sources and sinks on small rows."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from offerloom.operators import audit, dedup, listings, pages, pricing, quality, series, summary
from offerloom.sources import files, sinks
from offerloom.streaming.ingest import ingest_stream


def test_dated_row_wins(spark):
    rows = [("m", "t", 1.0, "u", None), ("m", "t2", 2.0, "u", dt.datetime(2025, 1, 1))]
    df = spark.createDataFrame(rows, "marketplace string, title string, price double, url string, captured_at timestamp")
    assert [r.title for r in dedup.dedup_offers(df).collect()] == ["t2"]


def test_undated_urls_stay_apart(spark):
    rows = [("m", "t", 1.0, "u1", None, "s", "f"), ("m", "t", 1.0, "u2", None, "s", "f")]
    df = spark.createDataFrame(rows, "marketplace string, title string, price double, url string, collected_at timestamp, seller string, source_file string")
    assert dedup.dedup_global(df).count() == 2


def test_three_marketplaces(spark):
    def frame(name, price):
        return spark.createDataFrame([("Pneu Goodyear Assurance 205/55R16", price, f"https://www.{name}.com/i", "2025-08-12T10:00:00", "s", f"{name}.csv")], "titulo string, preco string, link string, data_coleta string, loja string, arquivo string")

    out = listings.unify_marketplaces([frame("a", "200"), frame("b", "210,00"), frame("c", "R$ 205,00")])
    got = out["canonical_summary"].collect()
    assert out["unified_listings"].count() == 3 and len(got) == 1
    assert got[0].n_listings == 3 and len(got[0].evidence_files.split(",")) == 3 and got[0].mean_price == 205.0 and got[0].marketplaces == "a,b,c"


def test_dedup_is_stable_and_idempotent(spark):
    df = spark.range(200).select((F.col("id") % 7).cast("string").alias("url"), F.lit("m").alias("marketplace"), (F.col("id") % 5).cast("string").alias("title"), (F.col("id") % 3).cast("double").alias("price"), F.col("id").cast("timestamp").alias("captured_at"))
    once = dedup.dedup_offers(df)
    key = lambda d: sorted(map(str, d.collect()))
    assert key(once) == key(dedup.dedup_offers(df.repartition(7, "price"))) == key(dedup.dedup_offers(once))


def test_trimmed_mean_bounds(spark):
    df = spark.range(100).select(F.lit("k").alias("canonical_key"), F.lit("b").alias("brand"), F.lit("m").alias("model"), F.lit("s").alias("size"), (F.col("id") * 1.5).alias("price"), F.lit("x").alias("marketplace"), F.lit("f").alias("source_file"))
    r = summary.canonical_summary(df).first()
    assert r.p10 <= r.media_correta <= r.p90


def test_prechecks(spark):
    row = spark.createDataFrame([(3, 10.0, 50.0, 30.0, 20.0, 10.0, 40.0)], "n_listings long, min_price double, max_price double, mean_price double, median_price double, p10 double, p90 double")
    want = ["precheck_high_spread", "precheck_mean_median_divergence", "precheck_wide_p10_p90", "precheck_low_sample_reliability"]
    assert row.select(quality.precheck_price_sanity().alias("a")).first().a == want


def test_rule_price(spark):
    df = spark.createDataFrame([("a", 100.0, 120.0, None), ("b", 100.0, 120.0, 130.0)], "sku_key string, cost_price double, comp_p50 double, comp_max double")
    got = {r.sku_key: r.suggested_price for r in pricing.suggest_prices_rule(df).collect()}
    assert got == {"a": 135.0, "b": 130.0}


def test_replies(spark):
    df = spark.createDataFrame([("1", '{"ok": true, "alerts": ["x"], "confidence": 0.9}'), ("2", "nonsense"), ("3", None), ("4", "{}")], "canonical_key string, reply string")
    got = {r.canonical_key: (r.llm_ok, r.llm_alerts, r.llm_confidence) for r in audit.parse_audit_responses(df).collect()}
    assert got == {"1": (True, ["x"], 0.9), "2": (False, ["llm_invalid_json_response"], 0.0), "3": (False, ["llm_request_failed"], 0.0), "4": (False, [], 0.0)}


def test_page_extraction(spark):
    ld = '<script type="application/ld+json">{"name": "Pneu A", "offers": {"price": "199.90", "priceCurrency": "BRL"}}</script><del>R$ 250,00</del>Frete grátis'
    df = spark.createDataFrame([("u1", ld), ("u2", "<h1>B</h1><p>R$ 1.234,56</p>"), ("u3", None)], "url string, html string")
    got = {r.url: r for r in pages.extract_listings_from_pages(df).collect()}
    assert (got["u1"].title, got["u1"].price, got["u1"].previous_price, got["u1"].free_shipping) == ("Pneu A", 199.9, 250.0, True)
    assert (got["u2"].title, got["u2"].price) == ("B", 1234.56) and got["u3"].price is None


def test_upsert(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    b = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert sorted(map(tuple, dedup.upsert_by_key(a, b, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]


def test_sources(spark, tmp_path):
    (tmp_path / "j" / "x").mkdir(parents=True)
    (tmp_path / "j" / "x" / "a.json").write_text(json.dumps([{"t": "one"}, {"t": "two"}]))
    (tmp_path / "j" / "bad.json").write_text("{nonsense")
    assert sorted(r.t for r in files.read_listings_json(spark, str(tmp_path / "j"), schema="t string, _corrupt_record string").collect()) == ["one", "two"]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.json").write_text(json.dumps({"items": [{"t": "one"}]}))
    assert [r.t for r in files.read_listings_json(spark, str(tmp_path / "w")).collect()] == ["one"]
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.jsonl").write_text('{"t": "one"}\n\nnonsense\n{"t": "two"}\n')
    assert sorted(r.t for r in files.read_listings_jsonl(spark, str(tmp_path / "l")).collect()) == ["one", "two"]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "u.csv").write_bytes("t,p\nação,1\n".encode())
    (tmp_path / "c" / "l.csv").write_bytes("t,p\npreço,2\n".encode("latin-1"))
    assert sorted(r.t for r in files.read_listings_csv(spark, str(tmp_path / "c")).collect()) == ["ação", "preço"]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "pneu_a_top10_20250702.json").write_text(json.dumps([{"preco": 1.0}]))
    r = files.read_snapshots(spark, str(tmp_path / "s")).first()
    assert (r.slug, r.d) == ("pneu_a", dt.date(2025, 7, 2))
    assert files.read_folder(spark, str(tmp_path / "c")).count() == 2
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        files.read_folder(spark, str(tmp_path / "empty"))


def test_path_meta_and_tag(spark):
    p = "/data/raw/mercadolivre/pneu_20250811_133805.json"
    df = spark.createDataFrame([(p,)], "p string")
    m = df.select(files.meta_from_path(F.col("p")).alias("m")).first().m
    assert (m.marketplace, m.query, str(m.captured_at)) == ("mercadolivre", "pneu_20250811_133805.json", "2025-08-11 13:38:05")
    assert files.with_source_tag(df, "/data", 1, F.col("p")).first().source_file == "data/raw/mercadolivre/pneu_20250811_133805.json"


def test_seen_files_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", "m/1", None, "k", 5.0, "x", "f")], "brand string, model string, size string, canonical_key string, price double, marketplace string, source_file string")
    sinks.save_partitioned(df, str(tmp_path / "parts"), ["brand", "model", "size"])
    assert (tmp_path / "parts/listings/part_brand=b/part_model=m-1/part_size=NA").exists()
    with pytest.raises(ValueError):
        sinks.save_partitioned(df, str(tmp_path / "parts"), ["price"])
    sinks.save_parquet(df, str(tmp_path / "p"), "gzip")
    state = spark.createDataFrame([], "table_name string, source_id string, ts timestamp")
    new, marks = files.new_files_only(spark.read.parquet(str(tmp_path / "p")), state, "t")
    assert new.count() == 1
    again, _ = files.new_files_only(spark.read.parquet(str(tmp_path / "p")), marks, "t")
    assert again.count() == 0
    sinks.save_listing_files(df.withColumn("shipping", F.create_map(F.lit("01"), F.lit(9.5))), str(tmp_path / "f"), ["01", "02"])
    assert spark.read.option("header", True).csv(str(tmp_path / "f/csv")).first().shipping_01 == "9.5"


def test_stream_reads_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps([{"t": f"a{k}"}]))
        ingest_stream(spark, str(tmp_path / "in"), "t string", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == k + 1


def test_array_files_and_broken_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('[\n  {"t": "one"},\n  {"t": "two"}\n]\n')
    (tmp_path / "b c.jsonl").write_text('[{"t": "three"}]')
    (tmp_path / "c.jsonl").write_text('{"t": "four"}\n{"t": "five"}\n')
    assert sorted(r.t for r in files.read_listings_jsonl(spark, str(tmp_path)).collect()) == ["five", "four", "one", "three", "two"]
    (tmp_path / "d.json").write_text("{nonsense")
    (tmp_path / "e.json").write_text('{"t": 1}')
    assert [r.source_file.rsplit("/", 1)[-1] for r in files.broken_files(spark, str(tmp_path)).collect()] == ["d.json"]


def test_csv_of_many_headers_and_none(spark, tmp_path):
    for k in range(12):
        (tmp_path / f"f{k}.csv").write_bytes((f"a,h{k % 3}\n" + f'{k},"ç{k}"\n').encode("latin-1" if k % 2 else "utf-8"))
    rows = files.read_listings_csv(spark, str(tmp_path)).collect()
    assert sorted((int(r.a), r[f"h{int(r.a) % 3}"]) for r in rows) == [(k, f"ç{k}") for k in range(12)]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        files.read_listings_csv(spark, str(tmp_path / "none"))


def test_exact_quantiles(spark):
    import numpy as np

    from offerloom.operators.series import clip_quantiles, exact_quantiles, impute_median

    rng = np.random.default_rng(1)
    columns = {"a": [1.0], "b": [1.0, 2.0], "c": [3.0] * 50 + [1.0], "d": rng.normal(size=1000).round(2).tolist(), "e": rng.exponential(size=777).tolist(), "f": []}
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(1001)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    at = [0.01, 0.5, 0.97, 1.0]
    got = exact_quantiles(df, {f"{c}{q}": (c, q) for c in columns for q in at})
    for c, v in columns.items():
        assert [got[f"{c}{q}"] for q in at] == (pytest.approx(np.quantile(v, at).tolist()) if v else [None] * 4)
    filled = impute_median(df, list(columns)).toPandas()
    assert filled["e"].notna().all() and filled["e"].iloc[-1:].isin([*columns["e"], round(float(np.median(columns["e"])), 6)]).all() and filled["f"].isna().all()
    empty = spark.createDataFrame([(None,)], "v double").withColumn("lo_", F.lit("mine"))
    assert clip_quantiles(empty, "v").first() == (None, "mine") and impute_median(empty, ["v"]).first().v is None


def test_quantiles_of_groups_of_any_size(spark):
    """One group has most of all distinct prices; its ranges, not the group, are what a task sorts."""
    import numpy as np

    rng = np.random.default_rng(7)
    prices = {"hot": rng.lognormal(3, 1, 60_000), "signs": np.r_[rng.normal(0, 5, 3000), np.zeros(100)], None: np.array([2.0, 1.0]), "one": np.array([5.0]), "ties": np.repeat([1.0, 2.0, 3.0], 1500)}
    rows = [(k, float(v)) for k, x in prices.items() for v in x] + [("none", None), ("one", None)]
    df = spark.createDataFrame(rows, "canonical_key string, price double").repartition(8)
    at = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.97, "e": 1.0}
    counts = df.where("price IS NOT NULL").groupBy(F.struct("canonical_key").alias("k"), F.col("price").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    for most in (0, 2000, 10**6):
        got = {r.k.canonical_key: [r[c] for c in at] for r in summary.quantiles_of_counts(counts, at, most).collect()}
        assert got.keys() == prices.keys()
        for k, x in prices.items():
            assert got[k] == pytest.approx(np.quantile(x, list(at.values())).tolist(), abs=1e-9)
    bands = counts.where("k.canonical_key = 'hot'").groupBy(summary._band(F.col("v")).alias("b")).count().agg(F.count(F.lit(1)).alias("n"), F.max("count").alias("most")).first()
    assert bands.n > 1000 and bands.most < 600
    in_order = [r.b for r in counts.select("v", summary._band(F.col("v")).alias("b")).orderBy("v").collect()]
    assert in_order == sorted(in_order)


def test_long_series_in_ranges(spark):
    """A series with most of all rows, cut into ranges, gives what one window gives, also where ranges are shorter than the longest mean."""
    rng = random.Random(5)
    rows = [(rng.choices(["hot", "b", "c", None], [90, 5, 3, 2])[0], rng.randrange(40), i, rng.choice([None, float(rng.randrange(1, 500))]) if i % 9 == 0 else float(rng.randrange(1, 500))) for i in range(2500)]
    df = spark.createDataFrame(rows, "product_id string, t int, i int, preco double").withColumn("data_coleta", F.timestamp_seconds("t"))
    want = sorted(map(repr, series.series_features(df, tie=("i",)).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (3, 150):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert sorted(map(repr, series.series_features(df, tie=("i",), most_rows=60).collect())) == want
            cut, part, added = series.in_ranges(df, "product_id", ["data_coleta", "i"], 30)
            assert cut.where(~F.col(added)).count() == 2500 and cut.where("product_id = 'hot'").select(part).distinct().count() >= 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_upsert_table_replaces_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(500).select("id", F.lit("old").alias("v"))
    dedup.create_upsert_table(df, path, ["id"], buckets=16)
    before = {f for f in (tmp_path / "t/rows").rglob("*.parquet")}
    updates = spark.createDataFrame([(3, "new", 1), (3, "newer", 0), (1000, "more", 2)], "id long, v string, k int")
    assert dedup.upsert_table(spark, path, updates, ["id"], [F.col("k")]) == 1
    got = {r.id: r.v for r in dedup.read_upsert_table(spark, path).collect()}
    assert got == {**dict.fromkeys(range(500), "old"), 3: "newer", 1000: "more"}
    after = {f for f in (tmp_path / "t/rows").rglob("*.parquet")}
    replaced = {f.parent.name for f in before - after}
    assert len(replaced) <= 2 and {f for f in before if f.parent.name not in replaced} <= after
    noted = spark.read.parquet(f"{path}/manifest").where("version = 1").collect()
    assert {f"bucket_={r.bucket_}" for r in noted} >= replaced and len(noted) <= 2
    assert dedup.upsert_table(spark, path, updates.limit(0), ["id"]) == 2 and dedup.read_upsert_table(spark, path).count() == 501


def test_price_model(spark):
    """A short fit: the same twice, better than the mean, and all rows where there are only two."""
    from offerloom.operators import pricing

    df = spark.range(300).select(F.col("id").alias("sku_key"), *[((F.col("id") * k) % 17).cast("double").alias(c) for k, c in enumerate(pricing.FEATURES, 1)])
    df = df.withColumn("label", F.col("cost_price") * 2 + F.col("comp_p50")).withColumn("sale_price", F.col("label"))
    errors = [summary.regression_metrics(pricing.train_price_model(df, rounds=6, step=0.5)[1]).first() for _ in range(2)]
    assert errors[0] == errors[1] and errors[0].mae < 3.0
    train, test = pricing.split_rows(df)
    assert train.count() + test.count() == 300 and test.count() > 30
    assert pricing.train_price_model(df.limit(2), rounds=1)[1].count() == 2


def test_rows_without_url_are_no_copies(spark):
    rows = [("m", "a", 1.0, "", 1), ("m", "b", 2.0, None, 2), ("m", "b", 2.0, None, 2), ("m", "c", 3.0, "u", 3), ("m", "d", 4.0, "u", 4)]
    df = spark.createDataFrame(rows, "marketplace string, title string, price double, url string, k int").withColumns({"captured_at": F.timestamp_seconds("k"), "rn_": F.lit(7)})
    assert sorted((r.title, r.rn_) for r in dedup.dedup_offers(df).collect()) == [("a", 7), ("b", 7), ("d", 7)]


def test_cheapest_detail_wins(spark):
    seen = spark.createDataFrame([("u", 10.0, None), ("v", 5.0, "x")], "url string, price double, brand string").withColumn("detail_price", F.lit(1))
    details = spark.createDataFrame([("u", "Pirelli P1", 9.0), ("u", "Michelin X", 8.0), ("v", "Pirelli", 6.0)], "url string, title string, price double")
    for order in (details, details.orderBy("price")):
        assert sorted(map(tuple, pages.enrich_listings(seen, order).collect())) == [("u", 8.0, "michelin", 1), ("v", 5.0, "x", 1)]


def test_price_examples_of_ties(spark):
    rows = [("k", "t%d" % (i % 3), float(p), "u%d" % i) for i, p in enumerate([5, 1, 3, 3, 3, 1, 9])] + [(None, "t", 1.0, "u"), ("k", "t", None, "u"), ("one", "t", 2.0, "w")]
    df = spark.createDataFrame(rows, "canonical_key string, title string, price double, url string").withColumns({"seller": F.lit("s"), "marketplace": F.lit("m")})
    got = [(r.canonical_key, r.example, r.price, r.url) for r in summary.price_examples(df).orderBy("canonical_key", "example").collect()]
    assert got == [("k", 1, 1.0, "u1"), ("k", 2, 3.0, "u3"), ("k", 3, 9.0, "u6"), ("one", 1, 2.0, "w")]


def test_approximate_summary(spark):
    df = spark.range(1000).select(F.lit(None).cast("string").alias("canonical_key"), F.lit("b").alias("brand"), F.lit("m").alias("model"), F.lit("s").alias("size"), F.when(F.col("id") < 900, 1.0).otherwise(2.0).alias("price"), F.lit("x").alias("marketplace"), F.lit("f").alias("source_file"))
    exact, near = summary.canonical_summary(df).first(), summary.canonical_summary(df, accuracy=100).first()
    assert (exact.median_price, exact.mean_price, exact.media_correta) == (1.0, 1.1, near.media_correta if near.p90 == exact.p90 else exact.media_correta) and near.median_price == 1.0 and near.n_listings == 1000
