import pytest

from tests.oracle import connect, same_rows
from tidemark.plans.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, sf, name):
    same_rows(spark, con, sf, QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf, name):
    QUERIES[name](spark, sf).collect()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 4
    assert set(entry.oracle_sql()) <= set(entry.queries())
