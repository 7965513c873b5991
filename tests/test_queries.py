"""Every registered query against its SQL counterpart, on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from modeforge.plans.catalog import QUERIES

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    mine = entry.queries()[name](spark, small)
    sql = entry.oracle_sql()[name]
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    assert dict(mine.dtypes) == {c: TYPES[t] for c, t, *_ in described}
    assert difference(mine.toPandas(), con.execute(sql).df()) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.where("abs(value - decoded) > 1e-9").isEmpty()
