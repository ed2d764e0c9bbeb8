"""Every registered query against its independent DuckDB SQL (sf0.001), and
the driver contract of ``__spark_entry__``."""

import pytest

import __spark_entry__ as E
from churnlab.plans.registry import QUERIES as REGISTERED
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck_connect

QUERIES = {name: E.queries()[name] for name in REGISTERED}
SQL = E.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    con = duck_connect(SF_SMALL)
    result = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert result["ok"], result


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "user_id" in df.columns
