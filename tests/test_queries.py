"""Every registered query against its SQL, over whole tables."""

import __spark_entry__ as entry
import pytest
from candlemill.registry.oracle import ORACLE
from candlemill.registry.queries import QUERIES
from compare import assert_same, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert assert_same(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert {"in_RSI", "in_BBandMiddle", "in_StochLineD"} <= set(df.columns)
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
