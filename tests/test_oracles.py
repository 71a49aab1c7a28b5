"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con: duckdb.DuckDBPyConnection = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert differences(ours, duck.execute(ORACLES[name]).df()) == []
    else:
        assert len(ours) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
