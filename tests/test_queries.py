"""Every registered query beside its SQL, on the smallest driver tables."""

from pathlib import Path

import pytest
from compare import connection, difference

import __spark_entry__ as entry
from revlens.plans.queries import REGISTERED

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connection(SF)


def test_every_query_has_its_sql():
    assert set(entry.oracle_sql()) - set(entry.LLM_SQL) == set(REGISTERED)
    assert set(entry.LLM_SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, con, name):
    # A table this small may have no row to show for a query; none may differ.
    found = difference(spark, con, SF, entry.queries()[name], entry.oracle_sql()[name])
    assert found in (None, "no rows"), found


def test_entry(spark):
    assert entry.entry(spark).count() == 2
