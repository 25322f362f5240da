"""Keeping the first of equal keys, within a table and against a log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_of(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """For each key the row that came first, by a map-side aggregate. Nulls in a key are one key."""
    packed = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(F.struct(*[F.col(c) for c in rows.columns]), F.col(order)).alias("_row"))
    return packed.select("_row.*")


def withdrawn(tombstones: DataFrame) -> DataFrame:
    return tombstones.filter("action = 'withdraw' and event_id is not null").select(F.col("event_id").alias("id")).distinct()


def new_events(batch: DataFrame, log: DataFrame | None, tombstones: DataFrame | None, key: str = "id", order: str = "seq") -> DataFrame:
    """What of a batch is new: once for each id, not in the log on any day, not withdrawn. Running it again adds nothing."""
    fresh = first_of(batch.filter(F.col(key).isNotNull()), [key], order)
    if log is not None:
        fresh = fresh.join(log.select(key), key, "left_anti")
    if tombstones is not None:
        fresh = fresh.join(withdrawn(tombstones).withColumnRenamed("id", key), key, "left_anti")
    return fresh.select(*batch.columns)
