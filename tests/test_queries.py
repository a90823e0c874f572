"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check import connect, kinds, normal

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    if name not in ORACLES:
        assert got.num_rows > 0
        return
    want = duck.execute(ORACLES[name]).to_arrow_table()
    names = sorted(want.column_names)
    assert sorted(got.column_names) == names
    assert normal(got, names) == normal(want, names)
    assert kinds(got, names) == kinds(want, names)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 10
