"""Every registered query with a DuckDB counterpart gives the same rows, on the smallest given tables."""

import inspect
import os

import duckdb
import pytest

from offerloom.operators import pricing
from offerloom.plans import catalog, composites, roundtrips  # noqa: F401

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(repr, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_same_rows(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, DATA).toPandas(), duck.execute(catalog.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_price_model(spark, monkeypatch):
    """Both queries run to the end from one fit, here of fewer rounds; by default there are as many as in the reference."""
    assert inspect.signature(pricing.train_price_model).parameters["rounds"].default == 300
    fits = []
    short = lambda t: fits.append(1) or full(t, rounds=3)
    full = pricing.train_price_model
    monkeypatch.setattr(pricing, "train_price_model", short)
    priced = catalog.QUERIES["suggest_ml"](spark, DATA)
    assert priced.count() == catalog.QUERIES["training_table"](spark, DATA).count() and priced.where("suggested_price IS NULL").isEmpty()
    error = catalog.QUERIES["price_model_error"](spark, DATA).first()
    assert error.mae > 0 and error.rmse >= error.mae and len(fits) == 1
    catalog._MODELS.clear()
