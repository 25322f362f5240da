"""The log kept up to date from a landing folder.

A file source with ``availableNow`` reads what has landed since the last checkpoint; each micro-batch is de-duplicated
against itself, the whole log and the withdrawn ids, checked, and appended. A failing check raises: nothing of the
batch is written and the checkpoint stays, so the next run meets the same files. Rows come late without bound (history
is filled backwards), so ids are remembered in the log itself, not in a watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.dedupe import new_events
from tidemark.quality import gate
from tidemark.sinks import exists


def keep_log(spark: SparkSession, landing: str, log: str, checkpoint: str, schema: StructType, tombstones: DataFrame | None = None, checks: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int = 100) -> int:
    """Process everything that has landed; returns the number of micro-batches that wrote."""
    wrote = []

    def commit(batch: DataFrame, number: int) -> None:
        known = spark.read.schema(schema).parquet(log) if exists(spark, log) else None
        fresh = new_events(batch, known, tombstones).persist()
        try:
            if checks is not None:
                gate(checks(fresh))
            if not fresh.isEmpty():
                fresh.write.mode("append").parquet(log)
                wrote.append(number)
        finally:
            fresh.unpersist()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    query = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(wrote)


def first_seen(events: DataFrame) -> DataFrame:
    """Streaming state by company and signal: the first day and the rows so far; works on a stream (update mode) as on a table."""
    return events.groupBy("cik", "signal_type").agg(F.min("filed").alias("first_filed"), F.count(F.lit(1)).alias("rows"))


def daily_counts(events: DataFrame, lateness: str = "30 days") -> DataFrame:
    """An extra for dashboards: events of each recorded day and signal with a watermark. Not for facts: late rows would be lost."""
    return events.withWatermark("recorded_at", lateness).groupBy(F.window("recorded_at", "1 day").alias("day"), "signal_type").agg(F.count(F.lit(1)).alias("events"))
