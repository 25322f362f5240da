"""The order in which an entity's distinct signals appeared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schema


def _bare(form: Column) -> Column:
    """Strips the characters of the amendment mark, not the suffix, as the published record does."""
    return F.regexp_replace(F.upper(form), "[/A]+$", "")


def _answers(report: str, days: int):
    return lambda o: (_bare(o["form"]) == report) & F.datediff(o["day"], F.col("day")).between(0, days)


def entity_sequences(events: DataFrame, entity: str = "cik", kind: str = "signal_type", day: str = "filed", filing: str = "accession", form: str = "form", order: str = "seq") -> DataFrame:
    """(entity, step, kind, day, filing, days_since_previous, steps, span_days), for entities of two steps or more.

    The first event of each kind counts, then the first kind of each filing; a late notice answered by the report it
    defers within its window, later in the sequence, is dropped. After the first aggregate an entity has at most as
    many rows as there are kinds, so the windows run over a handful of rows whatever its history.
    """
    cols = {entity: "entity", kind: "kind", day: "day", filing: "filing", form: "form", order: "ord"}
    e = events.select(*[F.col(c).alias(n) for c, n in cols.items()]).filter("entity is not null and day is not null and kind is not null")
    first = e.groupBy("entity", "kind").agg(F.min(F.struct("day", "ord", "filing", "form")).alias("s")).select("entity", "kind", "s.*")
    by_filing = Window.partitionBy("entity", F.coalesce("filing", F.concat(F.lit("#"), F.col("ord").cast("string")))).orderBy("day", "ord")
    one = first.withColumn("r", F.row_number().over(by_filing)).filter("r = 1").drop("r")
    in_order = Window.partitionBy("entity").orderBy("day", "ord")
    later = F.collect_list(F.struct("day", "form")).over(in_order.rowsBetween(1, Window.unboundedFollowing))
    answered = F.lit(False)
    for notice, (report, days) in schema.EXTENSION_WINDOWS.items():
        answered = answered | ((_bare(F.col("form")) == notice) & F.exists("later", _answers(report, days)))
    kept = one.withColumn("later", later).filter(~F.coalesce(answered, F.lit(False))).drop("later")
    whole = Window.partitionBy("entity")
    out = kept.select(
        "entity", F.row_number().over(in_order).alias("step"), "kind", "day", "filing", F.datediff("day", F.lag("day").over(in_order)).alias("days_since_previous"),
        F.count(F.lit(1)).over(whole).alias("steps"), F.datediff(F.max("day").over(whole), F.min("day").over(whole)).alias("span_days"),
    )
    return out.filter("steps >= 2")
