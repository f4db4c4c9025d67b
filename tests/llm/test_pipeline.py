"""The pipeline's stages, and the corpus queries that have a DuckDB counterpart, on the smallest given tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offerloom.llm import queries
from offerloom.llm.common import materialize

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(repr, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    assert rows(queries.QUERIES[name](spark, DATA).toPandas()) == rows(con.execute(queries.ORACLE[name]).df())


def test_stages(spark):
    docs = queries.table(spark, DATA, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = materialize(stage(spark, docs, DATA), name)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns and after.items() <= before.items() and after
        if name == "exact_dedup":
            last = {t: i for i, t in sorted(before.items())}
            assert set(after) == set(last.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {r.doc_id for r in packed} == set(after)
    assert max(r.offset + r.length for r in packed) <= 4096


def test_mixing_keeps_all(spark):
    docs = queries.table(spark, DATA, "documents")
    assert sorted(r.doc_id for r in corpus_pipeline.mixing(spark, docs, DATA).select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_stages_against_brute_force(spark):
    """Near copies by all pairs; the mix as the order of its schedule; the pieces of the packed documents."""
    from tests.llm.test_corpus import brute_components

    docs = queries.table(spark, DATA, "documents")
    rows = docs.orderBy("doc_id").collect()
    want = {rows[k].doc_id for k, (_, c) in enumerate(brute_components([r.text for r in rows])) if c == k}
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, DATA).select("doc_id").collect()} == want

    mix = materialize(corpus_pipeline.mixing(spark, docs, DATA), "mix")
    slots = {r.doc_id: r.slot for r in queries.op7_source_mixing(spark, DATA).collect()}
    files = mix.select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    order = [r.doc_id for r in sorted(files, key=lambda r: (int(r.file_name[5:10]), r.row_index))]
    assert [slots[i] for i in order] == sorted(slots.values())
    packed = corpus_pipeline.packing(spark, mix, DATA).collect()
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed} == {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in queries.op9_best_fit_packing(spark, DATA).collect()}


def test_stages_of_nothing_and_of_odd_rows(spark):
    docs = queries.table(spark, DATA, "documents")
    odd = docs.limit(20).unionByName(docs.limit(5)).unionByName(docs.limit(3).withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes}))
    odd = materialize(odd.withColumn("slot", F.lit("extra")), "odd")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0
        if name != "packing":
            out = stage(spark, odd, DATA)
            assert out.columns == odd.columns and 0 < out.count() <= odd.count()
    assert corpus_pipeline.packing(spark, odd, DATA).count() >= odd.count()
