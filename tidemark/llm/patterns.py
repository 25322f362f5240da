"""Frequent ordered patterns across many entities' sequences, gaps allowed.

The positions of an entity are its distinct days. For each event type the days on which it occurs are a bit
vector, 64 days to a word. A pattern's vector holds the days on which it can end; the next step's vector is the
days strictly after the first of these (shift), intersected with the days of the added type. Patterns are
extended depth-first over blocks of entities, and an entity counts where any bit is left.

Blocks are counted apart and their counts added, so no entity list and no pattern list leaves its task but the
sums. Types that too few entities show are dropped before (no pattern with them can be frequent), which bounds
the patterns by (entities' types / share) to the power of the length, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import land

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
ONE = np.uint64(1)
BLOCK = 4_096


def after_first(bits: np.ndarray) -> np.ndarray:
    """For each row of words (low days first): all days strictly after the first set bit."""
    hit = bits != 0
    seen = np.logical_or.accumulate(hit, axis=1)
    first = hit.copy()
    first[:, 1:] &= ~seen[:, :-1]
    with np.errstate(over="ignore"):
        later = ~(bits ^ (bits - ONE)) & FULL
    out = np.where(first, later, np.uint64(0))
    out[:, 1:][seen[:, :-1]] = FULL
    return out


def count_patterns(vectors: np.ndarray, longest: int) -> dict[tuple[int, ...], int]:
    """vectors[type, entity, word] -> entities that show each pattern of 1..longest types."""
    counts: dict[tuple[int, ...], int] = {}

    def extend(pattern: tuple[int, ...], ends: np.ndarray, rows: np.ndarray) -> None:
        rest = after_first(ends)
        for kind in range(len(vectors)):
            reached = rest & vectors[kind][rows]
            alive = reached.any(axis=1)
            n = int(alive.sum())
            if n:
                grown = (*pattern, kind)
                counts[grown] = counts.get(grown, 0) + n
                if len(grown) < longest:
                    extend(grown, reached[alive], rows[alive])

    for kind in range(len(vectors)):
        rows = np.flatnonzero(vectors[kind].any(axis=1))
        if len(rows):
            counts[(kind,)] = len(rows)
            if longest > 1:
                extend((kind,), vectors[kind][rows], rows)
    return counts


def _vectors(entity: np.ndarray, day: np.ndarray, kind: np.ndarray, n: int, kinds: int) -> Iterator[np.ndarray]:
    """Bit vectors of n entities, in blocks of entities whose histories take equally many words."""
    order = np.lexsort((day, entity))
    entity, day, kind = entity[order], day[order], kind[order]
    new_entity = np.r_[True, entity[1:] != entity[:-1]]
    step = np.cumsum(np.r_[True, (day[1:] != day[:-1])] | new_entity)
    place = step - step[new_entity][np.cumsum(new_entity) - 1]
    words = np.zeros(n, np.int64)
    np.maximum.at(words, entity, place // 64 + 1)
    size = 1 << np.ceil(np.log2(np.maximum(words, 1))).astype(np.int64)
    for w in np.unique(size[words > 0]):
        members = np.flatnonzero((size == w) & (words > 0))
        for lo in range(0, len(members), max(1, BLOCK // int(w))):
            block = members[lo : lo + max(1, BLOCK // int(w))]
            slot = np.full(n, -1, np.int64)
            slot[block] = np.arange(len(block))
            mine = slot[entity] >= 0
            out = np.zeros((kinds, len(block), int(w)), np.uint64)
            np.bitwise_or.at(out, (kind[mine], slot[entity[mine]], place[mine] // 64), ONE << (place[mine] % 64).astype(np.uint64))
            yield out


def frequent_patterns(events: DataFrame, entity: str, kind: str, day: str, share: tuple[int, int] = (3, 100), longest: int = 4, shortest: int = 2) -> DataFrame:
    """(pattern array<string>, entities bigint, of_entities bigint): the patterns that at least ``share`` of the entities show.

    Rows with a null in any of the three columns are left out; repeated rows and several rows of one type on a day
    count once; steps lie on strictly later days. An empty table gives no pattern.
    """
    spark = events.sparkSession
    part, whole = share
    steps = events.select(F.col(entity).alias("entity"), F.col(kind).alias("kind"), F.col(day).cast("date").alias("day")).dropna().distinct()
    steps = land(steps, "steps")
    total = steps.agg(F.count_distinct("entity")).first()[0]
    # a type is kept where part/whole of the entities show it, so there are at most (types of an entity) * whole/part of them
    kept = [r.kind for r in steps.groupBy("kind").agg(F.count_distinct("entity").alias("n")).filter(F.col("n") * whole >= F.lit(part * total)).orderBy("kind").collect()]
    schema = "pattern array<int>, n bigint"
    if not kept:
        return spark.createDataFrame([], "pattern array<string>, entities bigint, of_entities bigint")
    names = F.array(*[F.lit(k) for k in kept])
    coded = steps.select("entity", F.datediff("day", F.lit("1970-01-01")).alias("day"), (F.array_position(names, F.col("kind")) - 1).cast("int").alias("kind")).filter("kind >= 0")
    kinds = len(kept)
    # a history holds at most one step for each day and type, so its size is bounded by the calendar
    histories = coded.groupBy("entity").agg(F.collect_list(F.struct("day", "kind")).alias("steps")).select("steps")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, ...], int] = {}
        for batch in batches:
            lists = batch.column("steps")
            flat = lists.flatten()
            if not len(flat):
                continue
            entity_ = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            day_, kind_ = (flat.field(i).to_numpy() for i in (0, 1))
            for vectors in _vectors(entity_, day_, kind_, len(lists), kinds):
                for pattern, n in count_patterns(vectors, longest).items():
                    totals[pattern] = totals.get(pattern, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array([list(p) for p in totals], pa.list_(pa.int32())), pa.array(list(totals.values()), pa.int64())], ["pattern", "n"])

    counted = histories.mapInArrow(count, schema).groupBy("pattern").agg(F.sum("n").alias("entities"))
    found = counted.filter((F.size("pattern") >= shortest) & (F.col("entities") * whole >= F.lit(part * total)))
    return found.select(F.transform("pattern", lambda i: F.get(names, i)).alias("pattern"), "entities", F.lit(total).cast("long").alias("of_entities"))


def first_by_id(rows: DataFrame, key: str, order: str) -> DataFrame:
    """For each value of ``key`` the row with the lowest ``order``: a map-side aggregate, so a hot key costs one row for each map task."""
    cols: list[Column] = [F.col(c) for c in rows.columns]
    return rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*cols), F.col(order)).alias("_row")).select("_row.*")
