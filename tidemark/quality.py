"""Checks of the log as one DataFrame, the hold of contradictory rows, and the gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions.scalars import base_form
from tidemark.functions.text import FLAGS, strip

OK, WARN, FAIL = "ok", "warn", "fail"

#: Words of the methods by which an entry may say it was found.
METHODS = ("item code", "comparison", "compared", "12b-25", "letter", "import", "note", "cover")


def _digits(c: Column) -> Column:
    return F.translate(c, "-", "")


def _tests() -> dict[str, tuple[str, Column, Column]]:
    """name -> (status where any row is bad, rows in question, bad rows)."""
    every = F.lit(True)
    compared = F.col("signal_type").isin(*schema.COMPARISON_SIGNALS)
    coded = (F.col("confidence") == "confirmed") & F.col("signal_type").isin(*schema.ITEM_SIGNALS.values())
    code = reduce(lambda w, kv: w.when(F.col("signal_type") == kv[1], kv[0]), schema.ITEM_SIGNALS.items(), F.when(F.lit(False), ""))
    quoted = F.coalesce(F.trim("quote") != "", F.lit(False))
    named = lambda f: F.coalesce(F.trim(F.col(f"evidence.{f}")) != "", F.lit(False))
    not_a_firm = lambda f: named(f) & ~F.col(f"evidence.{f}").rlike(r"\p{L}")
    return {
        "links to its own filing": (FAIL, every, ~F.coalesce(F.contains(_digits(F.col("filing_url")), _digits(F.col("accession"))), F.lit(False))),
        "states how it was found": (FAIL, every, ~F.coalesce(reduce(lambda a, m: a | F.lower("evidence.source").contains(m), METHODS, F.lit(False)), F.lit(False))),
        "item code matches the signal": (FAIL, coded, F.coalesce(F.col("evidence.item_code") != code, F.lit(True))),
        "comparison names an earlier filing": (FAIL, compared, F.coalesce(F.col("prior_accession"), F.lit("")) == ""),
        "comparison is of one form": (FAIL, compared & (F.coalesce(F.col("evidence.prior_form"), F.lit("")) != ""), base_form(F.col("evidence.prior_form")) != base_form(F.col("form"))),
        "comparison looks back": (FAIL, compared & (F.coalesce(F.col("evidence.prior_filed"), F.lit("")) != ""), F.coalesce(F.try_to_date("evidence.prior_filed") >= F.col("filed"), F.lit(False))),
        "quote opens with substance": (WARN, quoted, F.col("quote").rlike(r"^[\s,;:.)\]]")),
        "quote ends cleanly": (WARN, quoted, ~strip(F.col("quote")).rlike("[.!?;:\"”’)\\]…]\\z")),
        "quote contradicts its signal": (FAIL, quoted, contradicts(F.col("signal_type"), F.col("quote"))),
        "firm names hold letters": (FAIL, named("predecessor_auditor") | named("successor_auditor"), not_a_firm("predecessor_auditor") | not_a_firm("successor_auditor")),
    }


def row_checks(events: DataFrame) -> DataFrame:
    """(check, rows, bad, status): every row test in one pass over the log, whatever their number."""
    tests = _tests()
    sums = [a for i, (_, of, bad) in enumerate(tests.values()) for a in (F.count_if(of).alias(f"n{i}"), F.count_if(of & bad).alias(f"b{i}"))]
    row = events.agg(*sums)
    rows = [F.struct(F.lit(name).alias("check"), F.col(f"n{i}").alias("rows"), F.col(f"b{i}").alias("bad"), F.when(F.col(f"b{i}") > 0, worst).otherwise(OK).alias("status")) for i, (name, (worst, _, _)) in enumerate(tests.items())]
    return row.select(F.inline(F.array(*rows)))


def duplicate_check(events: DataFrame, key: str = "id") -> DataFrame:
    """Rows against distinct ids."""
    d = events.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("ids"))
    return d.select(F.lit("no duplicates").alias("check"), "rows", (F.col("rows") - F.col("ids")).alias("bad"), F.when(F.col("rows") > F.col("ids"), FAIL).otherwise(OK).alias("status"))


def currency_check(behind: Column, warn_after: int = 1, fail_after: int = 5) -> Column:
    return F.when(behind > fail_after, FAIL).when(behind > warn_after, WARN).otherwise(OK)


def summarise(checks: DataFrame) -> DataFrame:
    """Checks by status and the worst of them."""
    rank = F.when(F.col("status") == FAIL, 2).when(F.col("status") == WARN, 1).otherwise(0)
    worst = F.max(rank)
    return checks.agg(*[F.count_if(F.col("status") == s).alias(s) for s in (OK, WARN, FAIL)], F.when(worst == 2, FAIL).when(worst == 1, WARN).otherwise(OK).alias("overall"))


def gate(checks: DataFrame) -> None:
    """Raise where a check fails: what calls this commits nothing."""
    failed = [r.check for r in checks.filter(F.col("status") == FAIL).select("check").collect()]  # a handful of checks
    if failed:
        raise ValueError(f"failing checks: {', '.join(failed)}")


def contradicts(signal: Column, quote: Column) -> Column:
    """A row whose own quote says the opposite of its signal."""
    no_doubt = quote.rlike(FLAGS + r"\b(?:no|not)\b[^.;]{0,80}\b(?:substantial|grave)\s+doubt\b|\bdoubt\b[^.;]{0,120}\b(?:is|was|has been)\s+not\s+raised\b")
    effective = quote.rlike(FLAGS + r"\bcontrols?\b[^.;]{0,120}\b(?:was|were|is|are)\s+effective\b") & ~quote.rlike(FLAGS + r"\bnot\s+effective\b|material\s+weakness")
    return F.coalesce(((signal == "going_concern") & no_doubt) | ((signal == "material_weakness") & effective), F.lit(False))


def screen(batch: DataFrame, log: DataFrame, tombstones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(publishable, held): new contradictory rows are held whole; ids already in the log or withdrawn are in neither."""
    from tidemark.operators.dedupe import new_events

    fresh = new_events(batch, log, tombstones)
    bad = contradicts(F.col("signal_type"), F.col("quote"))
    return fresh.filter(~bad), fresh.filter(bad)


def open_holds(holds: DataFrame, log: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Holds that are still open: their accession and signal neither published nor withdrawn since."""
    from tidemark.functions.scalars import event_id
    from tidemark.operators.dedupe import withdrawn

    keyed = holds.withColumn("id", event_id(F.col("accession"), F.col("signal_type")))
    return keyed.join(log.select("id"), "id", "left_anti").join(withdrawn(tombstones), "id", "left_anti")


def strict_holds(holds: DataFrame) -> DataFrame:
    """The holds, or an error where one lacks a field: a queue that cannot be trusted stops the run."""
    blank = [F.coalesce(F.trim(F.col(f).cast("string")) == "", F.lit(True)) for f in schema.HOLD_FIELDS]
    return holds.withColumn("_ok", F.when(reduce(lambda a, b: a | b, blank), F.raise_error(F.concat(F.lit("hold without a field: "), F.coalesce("accession", F.lit("?"))))).otherwise(F.lit(True))).filter("_ok").drop("_ok")
