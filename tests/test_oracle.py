"""Every query with reference SQL gives the same rows as DuckDB (sf0.001)."""

import pytest

import __spark_entry__ as entry
from netpulse.plans.oracle import ORACLE_SQL
from netpulse.plans.queries import QUERIES
from conftest import SF_SMALL, duck_views
from helpers import canon

SQL = ORACLE_SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_reference_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck_views(duck, SF_SMALL).execute(SQL[name]).df()
    gc, gr = canon(got)
    wc, wr = canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_query_runs_and_keeps_schema(spark):
    for name in ["forecast_job", "entry"]:
        df = entry.entry(spark) if name == "entry" else entry.queries()[name](spark, SF_SMALL)
        assert df.columns == ["ds", "ip", "y", "yhat", "yhat_upper", "yhat_lower", "training_date"]
        assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(SQL) == {"forecast_job", "forecast_job_seasonal", "gbt_predict"}
