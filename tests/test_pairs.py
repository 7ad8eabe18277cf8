"""Every query with SQL must agree with it on the smallest tables."""

import __spark_entry__ as entry
import pytest
from check import compare, connect

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_pair(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = con.execute(ORACLES[name])
    sql_side = ([c[0] for c in cur.description], cur.fetchall())
    assert compare((df.columns, [tuple(r) for r in df.collect()]), sql_side) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_flagship_has_a_stable_schema(spark):
    assert entry.entry(spark).columns == ["is_test", "n", "mse", "mae", "r2"]
