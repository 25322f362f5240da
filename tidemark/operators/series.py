"""Ordered series: the row before, state changes, walks back through a run, first and newest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prior_in_series(rows: DataFrame, keys: list[str], day: str, order: str, carry: list[str], prefix: str = "prior_") -> DataFrame:
    """Each row with the latest earlier row of its series: same keys, a strictly earlier day; of one day the highest ``order``.

    Days are settled first: a series becomes one row a day by a map-side aggregate, the day before is a ``lag`` over
    at most as many rows as the calendar has days, and the rows join back. No task ever holds a series row by row.
    Rows whose key or day is null have no prior.
    """
    best = F.max(F.struct(F.col(order), *[F.col(c) for c in carry if c != order]))
    days = rows.filter(F.col(day).isNotNull()).groupBy(*keys, day).agg(best.alias("_best"))
    w = Window.partitionBy(*keys).orderBy(day)
    stepped = days.select(*keys, day, F.lag(day).over(w).alias("_day"), F.lag("_best").over(w).alias("_prior")).filter("_prior is not null")
    joined = rows.join(stepped, [*keys, day], "left")
    named = [F.col("_prior")[c].alias(prefix + c) for c in carry]
    return joined.select(*[F.col(c) for c in rows.columns], F.col("_day").alias(prefix + day), *named)


def transitions(rows: DataFrame, state: str, prior_state: str, ladder: list[str] | None = None) -> DataFrame:
    """The rows whose state differs from the prior one (both known), with ``direction`` along the ladder."""
    out = rows.filter(F.col(state).isNotNull() & F.col(prior_state).isNotNull() & (F.col(state) != F.col(prior_state)))
    if ladder:
        at = lambda c: F.array_position(F.array(*map(F.lit, ladder)), F.col(c))
        out = out.withColumn("direction", F.when(at(state) > at(prior_state), "escalated").otherwise("eased"))
    return out


RANGE = 50_000


def in_ranges(rows: DataFrame, keys: list[str], day: str, order: list[str], back: int, size: int = RANGE) -> tuple[DataFrame, list[str]]:
    """The rows with ``_pos``, ``_range`` and ``_ghost``, and the columns to partition a window by that looks ``back`` rows back.

    A series is cut into ranges of ``size`` rows, each of which also gets the last ``back`` rows of the range before as
    ghosts; a window over a range then sees what it would see in the whole series, and no task holds more than a
    range. Places come from the row counts of days, of which a series has at most as many as the calendar. Rows whose
    day is null come first, as they sort first.
    """
    day_ = F.coalesce(F.col(day).cast("date"), F.lit("0001-01-01").cast("date"))
    dated = rows.withColumn("_day", day_)
    counts = dated.groupBy(*keys, "_day").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_day").alias("_d"), F.coalesce(before, F.lit(0)).alias("_before"))
    same = F.col("_day") == F.col("_d")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    within = F.row_number().over(Window.partitionBy(*keys, "_day").orderBy(*order)) - 1
    placed = dated.withColumn("_within", within).join(offsets, same).withColumn("_pos", F.col("_before") + F.col("_within"))
    part, last = F.floor(F.col("_pos") / size), F.col("_pos") % size >= size - back
    both = F.when(last, F.array(F.struct(part.alias("r"), F.lit(False).alias("g")), F.struct((part + 1).alias("r"), F.lit(True).alias("g")))).otherwise(F.array(F.struct(part.alias("r"), F.lit(False).alias("g"))))
    out = placed.select(*rows.columns, "_pos", F.inline(both).alias("_range", "_ghost"))
    return out, [*keys, "_range"]


def previous(rows: DataFrame, keys: list[str], day: str, order: list[str], value: str, size: int = RANGE) -> DataFrame:
    """Each row with ``prior_<value>``: the value of the row right before it in its series, null for the first."""
    spread, by = in_ranges(rows, keys, day, order, 1, size)
    w = Window.partitionBy(*by).orderBy("_pos")
    return spread.withColumn(f"prior_{value}", F.lag(value).over(w)).filter("not _ghost").select(*rows.columns, f"prior_{value}")


def run_before(rows: DataFrame, keys: list[str], day: str, order: str, bad: Column, back: int = 6, size: int = RANGE) -> DataFrame:
    """For each row the unbroken run of ``bad`` rows right before it, at most ``back`` of them: ``run_len`` and ``run_start``."""
    spread, by = in_ranges(rows.withColumn("_bad", F.coalesce(bad, F.lit(False))), keys, day, [order], back, size)
    w = Window.partitionBy(*by).orderBy("_pos").rowsBetween(-back, -1)
    seen = F.reverse(F.collect_list(F.struct(F.col("_bad").alias("bad"), F.col(day).alias("day"))).over(w))
    stop = F.array_position(F.transform("_seen", lambda s: s["bad"]), F.lit(False))
    n = F.when(stop > 0, stop - 1).otherwise(F.size("_seen")).cast("int")
    out = spread.withColumn("_seen", seen).filter("not _ghost").withColumn("run_len", n).withColumn("run_start", F.when(F.col("run_len") > 0, F.get("_seen", F.col("run_len") - 1)["day"]))
    return out.select(*rows.columns, "run_len", "run_start")


def newest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row for each key, the first in ``order``; an aggregate on packed rows, so a hot key meets no window."""
    return top_per_group(rows, [key], 1, *order)


def top_per_group(rows: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each group, with ``rank``. Spark prunes before the shuffle, so a map task sends k rows of a group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def new_elements(rows: DataFrame, current: str, prior: str) -> Column:
    """Sorted elements of ``current`` that ``prior`` lacks; a null array is empty."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_except(F.coalesce(F.col(current), empty), F.coalesce(F.col(prior), empty)))


def renamed_between(rows: DataFrame, names: DataFrame, key: str, after: str, upto: str) -> DataFrame:
    """Each row with ``renamed_from``: the first former name (by ``pos``) whose ``until`` lies from ``after`` to ``upto``.

    ``names`` is (key, pos, name, until), a handful of rows a key; they are gathered by key first, so the interval is
    tested inside the row and nothing multiplies. Without such a name the column is null.
    """
    kept = names.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "name", "until"))).alias("_names"))
    inside = F.filter("_names", lambda n: n["until"].between(F.col(after), F.col(upto)))
    return rows.join(kept, key, "left").withColumn("renamed_from", F.get(inside, 0)["name"]).drop("_names")


def latest_runs(runs: DataFrame, day: str, order: str) -> DataFrame:
    """The last run of each day that was neither blocked nor to be retried."""
    good = runs.filter(~F.coalesce("blocked", F.lit(False)) & ~F.coalesce("retryable", F.lit(False)))
    return good.groupBy(day).agg(F.max_by(F.struct(*[c for c in runs.columns if c != day]), order).alias("_r")).select(day, "_r.*")
