import pytest

from tests import edges
from tidemark.plans.registry import QUERIES


@pytest.fixture(scope="module")
def empty(spark, sf, tmp_path_factory):
    return edges.empty_tables(spark, sf, tmp_path_factory.mktemp("empty"))


@pytest.fixture(scope="module")
def dirty(spark, sf, tmp_path_factory):
    return edges.dirty_tables(spark, sf, tmp_path_factory.mktemp("dirty"))


NAMES = sorted(n for n in QUERIES if not n.endswith("_cases"))


@pytest.mark.parametrize("name", NAMES)
def test_without_rows(spark, empty, name):
    QUERIES[name](spark, empty).collect()


@pytest.mark.parametrize("name", NAMES)
def test_with_nulls_repeats_and_clashing_columns(spark, dirty, name):
    QUERIES[name](spark, dirty).collect()
