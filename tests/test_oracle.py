"""Every registered query against its SQL oracle (DuckDB) on sf0.001."""

import os

import pytest

from tessera import plans
from tests.oracle_check import compare, duck

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = plans.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in plans.ORACLE:
        assert rows is not None
        return
    res = con.execute(plans.ORACLE[name])
    err = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert err is None, err


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() >= 0 and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize(
    "name, keys", [("q_daily_events", ["date", "event_count"]), ("q_user_activity", ["total_events"]), ("q_hourly_recent", ["hour"])]
)
def test_results_come_in_order(spark, con, name, keys):
    """The comparison above sorts both sides; here the order itself, as far as the query defines it."""
    got = [tuple(r[k] for k in keys) for r in plans.QUERIES[name](spark, SF).collect()]
    res = con.execute(plans.ORACLE[name])
    at = [[d[0] for d in res.description].index(k) for k in keys]
    assert got == [tuple(r[i] for i in at) for r in res.fetchall()] and len(got) > 1


def test_every_library_query_has_an_oracle():
    assert set(plans.QUERIES) == set(plans.ORACLE)
