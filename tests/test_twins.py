"""Every registered query gives the rows of its SQL twin."""

import pytest

from __spark_entry__ import entry
from compare import connect, difference
from driver.oracles import SQL
from driver.queries import ALL


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_a_twin():
    assert set(ALL) == set(SQL)


@pytest.mark.parametrize("name", sorted(ALL))
def test_twin(spark, con, sf, name):
    assert difference(spark, con, sf, ALL[name], SQL[name]) is None


def test_entry(spark):
    rows = entry(spark).collect()
    assert sum(r["n"] for r in rows) == 150
