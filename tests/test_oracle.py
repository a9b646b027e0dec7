"""Every registered query against its DuckDB oracle (the driver's gate),
on the smallest tables; the flagship also at sf0.01."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle import compare, duck

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con_small, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con_small, ORACLE[name])
    assert r.get("ok"), r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0
    assert df.columns


def test_flagship_at_sf001(spark):
    r = compare(QUERIES["flagship_join_sum"](spark, SF_ORACLE), duck(SF_ORACLE),
                ORACLE["flagship_join_sum"])
    assert r.get("ok"), r
    assert r["rows_spark"] > 1000


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["l_shipdate", "total_sales"]
    assert df.count() > 0


def test_every_query_has_a_survey_id():
    from tablekit.plans.registry import IDS
    from tablekit.plans.registry import QUERIES as PLANS
    assert all(IDS[n] for n in PLANS), [n for n in PLANS if not IDS[n]]
