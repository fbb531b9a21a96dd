"""Driver contract: entry smoke, registry shape, and a brute-force DuckDB check of cheap queries at sf0.001."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from tabulae.plans.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["r_name", "step_no", "step", "remaining", "excluded"]


def test_registry_shape():
    q, s = E.queries(), E.oracle_sql()
    assert len(q) >= 80 and set(s) <= set(q)
    assert all(callable(f) for f in q.values())


CHEAP = ["funnel", "missing", "key_uniqueness", "duplicate_detail", "describe", "histogram_log", "category_counts",
         "canonical_code", "composition", "silhouette", "error_by_band_models", "metrics_table"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("name", CHEAP)
def test_matches_oracle_small(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    di = [rel.columns.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in di) for r in rel.fetchall()), key=repr)
    assert srows == drows
