import pytest

from tests import edges
from tidemark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def empty(spark, sf, tmp_path_factory):
    return edges.empty_tables(spark, sf, tmp_path_factory.mktemp("empty"))


@pytest.fixture(scope="module")
def dirty(spark, sf, tmp_path_factory):
    return edges.dirty_tables(spark, sf, tmp_path_factory.mktemp("dirty"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_without_rows(spark, empty, name):
    rows = QUERIES[name](spark, empty).collect()
    assert rows == [] or (name == "p8_fill" and rows[0].containers == 0)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_with_nulls_repeats_and_clashing_columns(spark, dirty, sf, name):
    got = QUERIES[name](spark, dirty).collect()
    assert got
    if name in ("p1_found", "p5_found", "p6_found"):  # repeated rows and rows of nulls change nothing
        assert {str(r) for r in got} == {str(r) for r in QUERIES[name](spark, sf).collect()}
