"""The operators SQL can express, against their SQL."""

import pytest

from tessera.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck(SF).execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert compare(rows, df.columns, res.fetchall(), columns) is None and rows
