"""Filling containers of fixed capacity with items of varying length.

Items are spread by hash over packing partitions, each a size that one task handles. A partition is packed by
best-fit decreasing and certified: dual feasible functions give a lower bound on its containers, and a partition
that meets its bound cannot be packed better. The containers of the other partitions that have most room left are
opened, their items exchanged through a new hash and packed again, until every partition meets its bound or the
rounds are used up. Items longer than the capacity are split into full pieces and a rest.

Items of size zero take no room: they ride in the containers of their partition. Every item has exactly one
row for each piece.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import land

CAPACITY = 2_048
#: Tokens in a packing partition: some 2,000 full containers, so that tables of every size are packed in parallel and their gaps exchanged.
PARTITION_TOKENS = 4_000_000
#: A partition is also held to this many items, as items of size zero add no tokens.
PARTITION_ITEMS = 100_000
ROUNDS = 3


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item. Rooms are kept as one bit set, so the tightest room is found in one step."""
    order = np.argsort(-sizes, kind="stable")
    where = np.empty(len(sizes), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, used = 0, 0
    for i in order.tolist():
        size = int(sizes[i])
        fits = open_rooms >> size
        if size and fits:
            room = size + (fits & -fits).bit_length() - 1
            box = stacks[room].pop()
            if not stacks[room]:
                open_rooms ^= 1 << room
        elif size:
            box, room, used = used, capacity, used + 1
        else:
            where[i] = -1
            continue
        where[i] = box
        left = room - size
        if left:
            if not stacks[left]:
                open_rooms |= 1 << left
            stacks[left].append(box)
    zero = np.flatnonzero(where < 0)
    where[zero] = np.arange(len(zero)) % max(used, 1)
    return where


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Containers that the sizes need at least; ``counts[s]`` is the number of items of size s.

    The best of three families of dual feasible functions: the plain sum, for each threshold t the function that
    rounds sizes over capacity - t up and those under t down to nothing, and for each k the rounding of
    (k + 1) * size / capacity.
    """
    sizes = np.arange(capacity + 1, dtype=np.int64)
    counts = counts.astype(np.int64)
    total = int((sizes * counts).sum())
    best = -(-total // capacity)
    n_upto, sum_upto = np.cumsum(counts), np.cumsum(sizes * counts)
    t = np.arange(1, capacity // 2 + 1)
    large = n_upto[capacity] - n_upto[capacity - t]
    middle = sum_upto[capacity - t] - sum_upto[t - 1]
    best = max(best, int(np.max(large + -(-middle // capacity), initial=0)))
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, (scaled // capacity) * capacity)  # times k * capacity
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def _pack_groups(capacity: int):
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        sizes = part["size"].to_numpy(np.int64)
        ordered = part.sort_values(["size", "item", "piece"], ascending=[False, True, True])
        sizes = ordered["size"].to_numpy(np.int64)
        box = best_fit_decreasing(sizes, capacity)
        bins = int(box.max()) + 1 if len(box) else 0
        bound = max(lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity), 1)
        room = capacity - np.bincount(box, weights=sizes, minlength=bins).astype(np.int64)
        ordered["box"] = box
        ordered["room"] = room[box]
        ordered["gap"] = bins - bound
        return ordered[["part", "item", "piece", "size", "box", "room", "gap"]]

    return pack


def pieces(items: DataFrame, item: str, size: str, capacity: int) -> DataFrame:
    """(item, piece, size): one row for an item that fits, full pieces and a rest for one that doesn't. A null size is 0."""
    n = F.coalesce(F.col(size), F.lit(0)).cast("long")
    full = F.greatest(F.lit(1), F.ceil(n / F.lit(capacity))).cast("long")
    return items.select(F.col(item).cast("long").alias("item"), n.alias("_n"), F.explode(F.sequence(F.lit(0).cast("long"), full - 1)).alias("piece")).select(
        "item", "piece", F.least(F.lit(capacity).cast("long"), F.col("_n") - F.col("piece") * capacity).alias("size")
    )


def pack(items: DataFrame, item: str, size: str, capacity: int = CAPACITY, rounds: int = ROUNDS, partition_tokens: int = PARTITION_TOKENS, partition_items: int = PARTITION_ITEMS) -> DataFrame:
    """(item, piece, size, container, position, room, certified).

    ``container`` is unique over all partitions and rounds; ``position`` counts from 0 within it, longest first;
    ``room`` is what its container has left; ``certified`` is true where the lower bound of its partition equals
    the containers used. An empty table gives an empty result; repeated items are packed as items of their own.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    todo = land(pieces(items, item, size, capacity), "pieces")
    fields = "part long, item long, piece long, size long, box long, room long, gap long"
    done: DataFrame | None = None
    last = 0
    for turn in range(rounds):
        tokens, n = todo.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
        if n == 0:
            break
        parts = max(-(-tokens // partition_tokens), -(-n // partition_items), 1)
        spread = todo.withColumn("part", F.pmod(F.xxhash64("item", "piece", F.lit(turn)), F.lit(parts)))
        packed = land(spread.groupBy("part").applyInPandas(_pack_groups(capacity), fields), f"packed{turn}")
        more = turn + 1 < rounds and parts > 1
        # only a container with room for more can be what a partition has too many of; full ones stay closed
        opened = (F.col("gap") > 0) & (F.col("room") > 0) & F.lit(more)
        closed = packed.filter(~opened).select(F.lit(turn).alias("turn"), "part", "box", "item", "piece", "size", "room", (F.col("gap") <= 0).alias("certified"))
        done = closed if done is None else done.unionByName(closed)
        last = turn
        if not more:
            break
        todo = packed.filter(opened).select("item", "piece", "size")
    if done is None:
        done = todo.select(F.lit(last).alias("turn"), F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("box"), "item", "piece", "size", F.lit(0).cast("long").alias("room"), F.lit(True).alias("certified"))
    return number(done)


def number(done: DataFrame) -> DataFrame:
    """Name the containers and set the positions; a container holds at most ``capacity`` items of size one or more."""
    container = F.concat_ws("-", "turn", "part", "box").alias("container")
    order = Window.partitionBy("turn", "part", "box").orderBy(F.desc("size"), "item", "piece")
    return done.select("item", "piece", "size", container, (F.row_number().over(order) - 1).alias("position"), "room", "certified")
