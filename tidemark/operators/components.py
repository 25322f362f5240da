"""Connected components by alternating star contraction: aggregates and equi-joins only, no neighbour list is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import land

ROUNDS = 40


def _landed(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges written as a table, and a mark of what they are, taken as they are written."""
    seen = Observation()
    done = land(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")), "edges")
    return done, (seen.get["n"], seen.get["x"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge (a, b); ``root`` is the smallest node of its component.

    Loops, nulls and repeated edges are ignored; no edges give no rows. Rounds grow with the logarithm of the
    longest path; a run that does not settle in ``ROUNDS`` raises rather than return a half-joined result.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a is not null and b is not null and a <> b").distinct()
    e, mark = _landed(e)
    for _ in range(ROUNDS):
        if not mark[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small = moved.unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        before = mark
        e, mark = _landed(small)
        if before == mark:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots).distinct()
