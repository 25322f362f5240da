import datetime as dt
import itertools
import random

import pytest

from tidemark.llm import patterns

SCHEMA = "cik long, kind string, day date, pattern string"


def brute(rows, share, longest):
    by = {}
    for c, k, d, _ in rows:
        if None not in (c, k, d):
            by.setdefault(c, set()).add((d, k))
    kinds = sorted({k for s in by.values() for _, k in s})

    def shows(steps, pattern):
        last = dt.date.min
        for want in pattern:
            later = [d for d, k in steps if k == want and d > last]
            if not later:
                return False
            last = min(later)
        return True

    out = {}
    for n in range(2, longest + 1):
        for p in itertools.product(kinds, repeat=n):
            k = sum(shows(s, p) for s in by.values())
            if k and k * share[1] >= share[0] * len(by):
                out[p] = k
    return out


@pytest.mark.parametrize("seed,days", [(1, 6), (2, 30), (3, 400)])
def test_against_brute_force(spark, seed, days):
    rng = random.Random(seed)
    rows = [(rng.randrange(12), rng.choice("abcd"), dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(days)), "clash") for _ in range(150)]
    rows += [(0, rng.choice("abcd"), dt.date(2024, 1, 1) + dt.timedelta(i), "clash") for i in range(200)]  # a long history: several words
    rows += [(None, "a", dt.date(2024, 1, 1), ""), (1, None, dt.date(2024, 1, 1), ""), (1, "a", None, ""), *rows[:20]]
    df = spark.createDataFrame(rows, SCHEMA)
    for share in ((3, 100), (1, 2)):
        got = {tuple(r.pattern): r.entities for r in patterns.frequent_patterns(df, "cik", "kind", "day", share, 3).collect()}
        assert got == brute(rows, share, 3)


def test_one_day_is_one_position(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1), ""), (1, "b", dt.date(2024, 1, 1), "")], SCHEMA)
    assert patterns.frequent_patterns(df, "cik", "kind", "day").collect() == []


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert patterns.frequent_patterns(df, "cik", "kind", "day").collect() == []


def test_first_by_id(spark):
    df = spark.createDataFrame([("x", 2, "b"), ("x", 1, "a"), (None, 3, "c"), (None, 4, "d")], "id string, seq int, v string")
    assert {(r.id, r.v) for r in patterns.first_by_id(df, "id", "seq").collect()} == {("x", "a"), (None, "c")}
