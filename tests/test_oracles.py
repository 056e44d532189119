"""Every query with an SQL oracle: Spark result == DuckDB result on sf0.001
(same columns, same rows after rounding doubles)."""

import os

import pytest

import __spark_entry__ as E
from tools.check_oracles import TABLES, rows_of

from conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_is_registered_with_a_callable():
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    assert all(callable(f) for f in qs.values())


OWN = sorted(n for n in ORACLES if not n.startswith("op"))  # tests/llm holds the others


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = duck.execute(ORACLES[name]).df()
    c1, r1 = rows_of(got)
    c2, r2 = rows_of(exp)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "period" in df.columns


FITTED = sorted(set(E.queries()) - set(ORACLES) - {n for n in E.queries() if n.startswith("op") or n == "pipeline"})


@pytest.mark.parametrize("name", FITTED)
def test_fitted_query_runs(spark, monkeypatch, name):
    """Fits have no SQL; they run whole, with fewer trees to save time."""
    from keepcurve.operators import boosting as bo
    from keepcurve.operators import models as mo

    monkeypatch.setattr(bo, "DEFAULTS", bo.BoostParams(trees=4))
    monkeypatch.setitem(mo.GBT_PARAMS, "maxIter", 8)
    monkeypatch.setitem(mo.UPLIFT_GBT_PARAMS, "maxIter", 4)
    rows = E.queries()[name](spark, SF_SMALL).collect()
    assert rows and all(v is not None for r in rows for v in r)
