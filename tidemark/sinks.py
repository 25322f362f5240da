"""Writing: the append-only log, its repair, exports and guarded stores."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import rfc822
from tidemark.operators.dedupe import first_of, new_events
from tidemark.session import land


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def append_events(batch: DataFrame, path: str, tombstones: DataFrame | None = None, by: str = "scan_day") -> int:
    """Append what is new to the log at ``path`` (partitioned by day) and return its row count. Repeating a batch adds nothing."""
    spark = batch.sparkSession
    log = spark.read.schema(batch.schema).parquet(path) if exists(spark, path) else None
    fresh = land(new_events(batch, log, tombstones), "fresh")
    n = fresh.count()
    if n:
        fresh.write.mode("append").partitionBy(by).parquet(path)
    return n


def repair(spark: SparkSession, path: str, by: str = "scan_day", key: str = "id", order: str = "seq") -> int:
    """Rewrite the days of the log that hold an id twice, first row kept; returns the rows removed."""
    log = spark.read.parquet(path)
    bad = log.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("k")).filter("n > k")
    damaged = land(log.join(bad.select(by), by, "left_semi"), "damaged")
    clean = land(first_of(damaged, [by, key], order), "clean")
    removed = damaged.count() - clean.count()
    if removed:
        clean.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return removed


def export_years(events: DataFrame, path: str, day: str = "filed") -> DataFrame:
    """JSON lines, a folder for each year; returns the index (year, events). The folders are disjoint and hold every dated row."""
    dated = events.filter(F.col(day).isNotNull()).withColumn("year", F.year(day))
    dated.write.mode("overwrite").partitionBy("year").json(path)
    return year_index(events, day)


def year_index(events: DataFrame, day: str = "filed") -> DataFrame:
    return events.filter(F.col(day).isNotNull()).groupBy(F.year(day).alias("year")).agg(F.count(F.lit(1)).alias("events"))


def save_guarded(result: DataFrame, path: str) -> bool:
    """Replace a stored result, unless an empty one would replace a filled one. The new copy is complete before the old goes."""
    spark = result.sparkSession
    staged = land(result, "guarded")
    if staged.isEmpty() and exists(spark, path) and not spark.read.parquet(path).isEmpty():
        return False
    beside = f"{path.rstrip('/')}.next-{uuid.uuid4().hex}"
    staged.write.parquet(beside)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(at(path), True)
    if not fs.rename(at(beside), at(path)):
        raise OSError(f"the new copy stays at {beside}")
    return True


def save_json(value: object, path: str) -> None:
    """A small control file, written beside and renamed."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=folder, suffix=f".{uuid.uuid4().hex}")
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, sort_keys=True, indent=1)
    os.replace(temp, path)


def load_json(path: str, default: object) -> object:
    """A control file, or the default where it is missing or damaged."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (OSError, ValueError):
        return default


def record_run(state: dict, run: dict, keep: int = 60) -> dict:
    """The state with one more run: its counters raise the day's totals, then only the newest runs are kept."""
    day = dict(state.get("scan_days", {}))
    if run.get("candidates") and not run.get("blocked"):
        old = day.get(run["date"], {})
        day[run["date"]] = {k: max(int(old.get(k, 0)), int(run.get(k) or 0)) for k in ("index_rows", "candidates")}
    return {**state, "scan_days": day, "runs": [*state.get("runs", []), run][-keep:]}


def feed_items(events: DataFrame, most: int = 60) -> DataFrame:
    """The newest entries for a feed: (position, guid, title, link, published, description)."""
    newest = events.orderBy(F.desc_nulls_last("filed"), F.desc_nulls_last("company"), F.asc("seq")).limit(most)
    return newest.select(F.col("id").alias("guid"), F.col("headline").alias("title"), F.col("filing_url").alias("link"), rfc822(F.col("filed")).alias("published"), F.coalesce("evidence.why", F.lit("")).alias("description"), "seq")


def feed_xml(items: DataFrame, title: str, link: str) -> str:
    """The feed's text from its few items."""
    body = "".join(
        f"<item><title>{escape(r.title or '')}</title><link>{escape(r.link or '')}</link><guid isPermaLink=\"false\">{escape(r.guid or '')}</guid><pubDate>{r.published or ''}</pubDate><description>{escape(r.description)}</description></item>"
        for r in items.collect()
    )
    return f'<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>{escape(title)}</title><link>{escape(link)}</link>{body}</channel></rss>'
