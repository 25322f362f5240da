import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import packing


def fewest(sizes, capacity):
    """The least containers, by trying everything."""
    sizes = sorted((s for s in sizes if s), reverse=True)
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in {r: j for j, r in enumerate(rooms) if r >= sizes[i]}.values():
            rooms[k] -= sizes[i]
            place(i + 1, rooms)
            rooms[k] += sizes[i]
        rooms.append(capacity - sizes[i])
        place(i + 1, rooms)
        rooms.pop()

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=9))
def test_bounds_hold(sizes):
    capacity = 20
    a = np.array(sizes, np.int64)
    box = packing.best_fit_decreasing(a, capacity)
    used = len(set(box[a > 0].tolist()))
    assert all(a[box == b].sum() <= capacity for b in set(box.tolist()))
    least = fewest(sizes, capacity)
    assert packing.lower_bound(np.bincount(a, minlength=capacity + 1), capacity) <= least <= used


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, None, rng.randrange(1, 90), rng.randrange(1, 500)]), "clash", "clash") for i in range(3_000)] + [(9_000, 1_000, "c", "c"), (9_001, 250, "c", "c"), (9_001, 250, "c", "c")]
    return spark.createDataFrame(rows, "doc long, n int, container string, size string")


@pytest.mark.parametrize("tokens", [10**9, 20_000])
def test_everything_is_placed_once(items, tokens):
    placed = packing.pack(items, "doc", "n", 100, partition_tokens=tokens).collect()
    want = {}
    for r in items.collect():
        want[r.doc] = want.get(r.doc, 0) + (r.n or 0)
    by = {}
    for r in placed:
        by.setdefault(r.item, []).append(r)
    assert {d: sum(p.size for p in ps) for d, ps in by.items()} == want
    assert all(len(ps) == 1 for d, ps in by.items() if want[d] <= 100 and d < 9_000)
    assert sorted(p.size for p in by[9_001]) == [50, 50, 100, 100, 100, 100] and [p.size for p in by[9_000]] == [100] * 10
    boxes = {}
    for r in placed:
        boxes.setdefault(r.container, []).append(r)
    for rows in boxes.values():
        assert sum(r.size for r in rows) <= 100 and sorted(r.position for r in rows) == list(range(len(rows)))
    total = sum(want.values())
    assert total / (100 * len([b for b in boxes.values() if sum(r.size for r in b)])) > 0.97


def test_exact_fits_are_certified(spark):
    placed = packing.pack(spark.createDataFrame([(i, 50) for i in range(10)], "doc long, n int"), "doc", "n", 100).collect()
    assert len({r.container for r in placed}) == 5 and all(r.certified for r in placed)


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc long, n int")
    assert packing.pack(empty, "doc", "n").collect() == []
    zeros = packing.pack(spark.createDataFrame([(1, 0), (2, None)], "doc long, n int"), "doc", "n").collect()
    assert sorted((r.item, r.size) for r in zeros) == [(1, 0), (2, 0)]
