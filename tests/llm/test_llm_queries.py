import pytest

from tests.oracle import connect, same_rows
from tidemark.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, sf, name):
    same_rows(spark, con, sf, QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    assert len(rows) == len({str(r) for r in rows})


def test_columns(spark, sf):
    want = {
        "p1_found": ["pattern string"], "p2_found": ["seq bigint", "field string"], "p3_found": ["seq bigint", "field string"], "p4_found": ["seq bigint", "field string", "ref_code string"],
        "p5_found": ["name_a string", "name_b string"], "p6_found": ["kept_seq bigint", "dup_seq bigint"], "p7_ids": ["doc_id bigint", "ids array<int>"], "p9_found": ["doc_id bigint", "subject_code string"],
    }
    for name, columns in want.items():
        assert [f"{c} {t}" for c, t in QUERIES[name](spark, sf).dtypes] == columns, name
