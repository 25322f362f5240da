"""How often one kind of event is followed by another within a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import percent


def _within(first: Column, window_days: int):
    return lambda d: (d > first) & (F.datediff(d, first) <= window_days)


def follow_on(events: DataFrame, entity: str, kind: str, day: str, pairs: list[tuple[str, str]], window_days: int, as_of: Column) -> DataFrame:
    """(first, second, with_first, eligible, immature, followed, rate) for each ordered pair of kinds.

    An entity counts from its first event of the first kind. It is eligible once the whole window has passed by
    ``as_of``; it is followed where an event of the second kind lies 1 to ``window_days`` days later. Rows after
    ``as_of`` and rows with nulls are left out.

    One shuffle: an entity becomes the first day and the distinct days of each kind, of which there are at most as
    many as the calendar has; the pairs are then settled row by row.
    """
    kinds = sorted({k for p in pairs for k in p})
    known = events.select(F.col(entity).alias("entity"), F.col(kind).alias("kind"), F.col(day).cast("date").alias("day")).filter(F.col("kind").isin(kinds) & F.col("entity").isNotNull() & (F.col("day") <= as_of))
    slots = {k: f"k{i}" for i, k in enumerate(kinds)}
    per = known.groupBy("entity").agg(*[F.collect_set(F.when(F.col("kind") == k, F.col("day"))).alias(s) for k, s in slots.items()])
    rows = []
    for i, (a, b) in enumerate(pairs):
        first = F.array_min(slots[a])
        mature = F.datediff(as_of, first) >= window_days
        hit = F.exists(slots[b], _within(first, window_days))
        rows.append(F.struct(F.lit(i).alias("pos"), F.lit(a).alias("first"), F.lit(b).alias("second"), first.isNotNull().alias("has"), mature.alias("mature"), hit.alias("hit")))
    flat = per.select(F.inline(F.array(*rows)))
    out = flat.groupBy("pos", "first", "second").agg(
        F.count_if("has").alias("with_first"), F.count_if(F.col("has") & F.col("mature")).alias("eligible"), F.count_if(F.col("has") & ~F.col("mature")).alias("immature"), F.count_if(F.col("has") & F.col("mature") & F.col("hit")).alias("followed")
    )
    return out.select("first", "second", "with_first", "eligible", "immature", "followed", percent(F.col("followed"), F.col("eligible")).alias("rate"))
