"""Every registered query next to its SQL twin."""

import oracle
import pytest

import __spark_entry__ as entry
from tallyford import catalog

QUERIES, SQL = {name: entry.queries()[name] for name in catalog.QUERIES}, entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    from conftest import DATA

    return oracle.connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert name in SQL
    found = oracle.difference(QUERIES[name](spark, sf_dir), con, SQL[name])
    # Small tables leave some results empty; those are compared on the larger ones.
    assert found is None or found == "no rows on either side"


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "eventKey", "time_stamp", "orgId", "userCountByOrg", "period", "relation_name"]
