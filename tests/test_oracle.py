"""Every registered query against its DuckDB twin (row count, columns, values),
and every rows-only query runs and returns rows -- on the smallest tables."""
import pytest

from dichot.plans.check import compare
from dichot.plans.queries import ORACLE, QUERIES

from conftest import SF_SMALL

#: hundreds of Spark jobs each at the reference's settings; the same code is held to
#: brute force, with fewer steps, in test_gbm.py, test_resampling.py and test_models.py
LONG = {"gbm_cv", "glmboost_cv", "model_job"}
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE) - LONG)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck_small, name):
    r = compare(spark, duck_small, name, SF_SMALL, QUERIES[name], ORACLE[name])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0
    assert len(df.columns) == len(set(df.columns))


def test_entry(spark):
    import __spark_entry__ as e
    out = e.entry(spark)
    rows = out.collect()
    assert [r["term"] for r in rows][:2] == ["(Intercept)", "price"]
    assert set(e.oracle_sql()) <= set(e.queries())
