"""Every registered query against its DuckDB oracle at sf0.001
(row count, column names, exact order-insensitive values)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from slotcast.catalog import registry
from tests.conftest import SF_SMALL

TABLES = "events".split()
registry.load_all()
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


def _canon(v):
    if v is None:
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_canon(x) for x in r) for r in df[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def test_every_key_has_oracle_or_is_documented():
    assert set(QUERIES) - set(ORACLE) == {"ml_fit_forecaster", "ml_evaluate_fitted", "promote_fitted"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    got = QUERIES[key](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLE[key]).df()
    c1, r1 = _rows(got)
    c2, r2 = _rows(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sensor_id", "bucket", "car_count", "observed"]


def test_fit_forecaster_rows(spark):
    res = QUERIES["ml_fit_forecaster"](spark, "/root/testdata/sf0.01").collect()
    assert len(res) == 3 and sum(r["selected"] for r in res) == 1
    assert all(math.isfinite(r["train_mse"]) for r in res)
