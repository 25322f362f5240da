"""A day's scan as one lazy plan: index rows in, publishable and held events out.

The cheapest test comes first (forms on the index), then the header's industry; only what is left meets a text. Each
branch reads its own forms; late notices of one company and day become one event before anything else is added.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import quality, schema
from tidemark.detect import items, spans
from tidemark.detect.conclusions import going_concern_headline
from tidemark.detect.periodic import changes
from tidemark.functions import scalars
from tidemark.functions.text import close_quote, mid_sentence, truncate_words
from tidemark.operators import firms
from tidemark.operators.views import same_day_notices
from tidemark.session import land, table
from tidemark.sinks import append_events, exists
from tidemark.sources.records import enrich

#: Periodic reports read for a day at most.
MOST_PERIODIC = 1_000

COLUMNS = ("seq", "id", "signal_type", "confidence", "cik", "company", "form", "filed", "accession", "severity", "headline", "quote", "prior_accession", "scan_day", "evidence")
#: What an event tells of how it was found; what does not fit the signal is null.
EVIDENCE = {
    "source": "string", "severity": "string", "item_code": "string", "item_title": "string", "direction": "string", "limb": "string", "predecessor_auditor": "string", "predecessor_tier": "string", "successor_auditor": "string",
    "successor_tier": "string", "tier_downgrade": "boolean", "disagreements_disclosed": "boolean", "successor_named": "boolean", "days_past_due_date": "int", "filings_in_batch": "bigint", "other_forms": "string",
    "topics": "array<string>", "citations": "array<string>", "prior_state": "string", "current_state": "string", "similarity": "double", "new_standards": "array<string>", "adoption_year": "int", "prior_form": "string", "prior_filed": "string",
}


def evidence(source: str | Column, **told: Column) -> Column:
    told["source"] = F.lit(source) if isinstance(source, str) else source
    return F.struct(*[told.get(n, F.lit(None)).cast(k).alias(n) for n, k in EVIDENCE.items()])


@dataclass
class Inputs:
    """``filings`` is the day index; ``headers`` (accession, header); ``documents`` (accession, text); ``history`` the earlier periodic
    reports (cik, form, filed, accession, seq, text); ``floats`` (cik, public_float)."""

    filings: DataFrame
    headers: DataFrame
    documents: DataFrame
    history: DataFrame
    floats: DataFrame


def candidates(i: Inputs) -> DataFrame:
    """The rows worth reading, with their route: forms first, then readable headers, then operating companies."""
    routed = i.filings.withColumn("route", scalars.form_route(F.col("form"))).filter("route is not null")
    return enrich(routed, i.headers).filter(scalars.is_operating(F.col("sic")))


def _event(rows: DataFrame, signal: Column, confidence: str, severity: Column, headline: Column, quote: Column, told: Column, prior: Column | None = None) -> DataFrame:
    return rows.select(
        "seq", scalars.event_id(F.col("accession"), signal).alias("id"), signal.alias("signal_type"), F.lit(confidence).alias("confidence"), "cik", "company", "form", "filed", "accession",
        severity.alias("severity"), headline.alias("headline"), quote.alias("quote"), (prior if prior is not None else F.lit(None).cast("string")).alias("prior_accession"), "scan_day", told.alias("evidence"),
    )


def item_branch(found: DataFrame, documents: DataFrame) -> DataFrame:
    """Auditor changes, non-reliance and officers who leave, from item codes; an amendment that only files a letter gives none."""
    one = found.filter("route = 'event'").withColumn("signal", F.explode(scalars.item_signals(F.col("items")))).join(documents, "accession", "left")
    told = one.filter(~(F.upper("form").endswith("/A") & items.only_the_letter(F.col("text"))))
    t, signal = F.col("text"), F.col("signal")
    auditor = signal == "auditor_change"
    told = told.withColumns({"out": F.nullif(spans.outgoing_firm(F.when(auditor, t)), F.lit("")), "in": F.nullif(spans.incoming_firm(F.when(auditor, t)), F.lit(""))})
    twice = firms.firm_key(F.col("out")) == firms.firm_key(F.col("in"))  # one firm on both sides was misread: neither is told
    told = told.withColumns({c: F.when(F.coalesce(~twice, F.lit(True)), F.col(c)) for c in ("out", "in")})
    tier = lambda c: F.when(F.col(c).isNotNull(), firms.firm_tier(F.col(c)))
    told = told.withColumns({"direction": F.when(auditor, items.auditor_direction(t)), "quarrel": F.when(signal != "restatement", items.disagreements(t)), "limb": F.when(signal == "restatement", items.non_reliance_limb(t)), "out_tier": tier("out"), "in_tier": tier("in")})
    told = told.withColumn("downgrade", items.tier_downgrade(F.col("out_tier"), F.col("in_tier")))
    grade = F.when(auditor, items.auditor_severity(F.col("direction"), F.col("quarrel"), F.col("downgrade"))).when(signal == "restatement", "high").otherwise(items.officer_severity(t))
    company, firm = F.col("company"), F.coalesce("out", F.lit("its auditor"))
    line = (
        F.when(signal == "restatement", F.concat(company, F.when(F.col("limb") == "b", " was told by its auditor not to rely on earlier statements").otherwise(" said earlier statements should not be relied on")))
        .when(auditor & F.coalesce("quarrel", F.lit(False)), F.concat(company, F.lit(" and "), firm, F.lit(" disagreed")))
        .when(auditor & F.col("direction").isin("resigned", "withdrawn", "declined"), F.concat(firm, F.lit(" "), F.when(F.col("direction") == "resigned", "resigned as auditor of ").when(F.col("direction") == "declined", "declined to stand again as auditor of ").otherwise("withdrew as auditor of "), company))
        .when(auditor, F.concat(company, F.when(F.col("direction") == "dismissed", " dismissed ").otherwise(" changed "), firm, F.coalesce(F.concat(F.lit(" for "), F.col("in")), F.lit(""))))
        .otherwise(F.concat(company, F.lit(" reported that a finance officer leaves"), F.when(F.coalesce(~items.successor_named(t), F.lit(False)), " without a successor").otherwise("")))
    )
    code = reduce(lambda w, kv: w.when(signal == kv[1], kv[0]), schema.ITEM_SIGNALS.items(), F.when(F.lit(False), ""))
    title = reduce(lambda w, kv: w.when(code == kv[0], kv[1]), items.ITEM_TITLES.items(), F.when(F.lit(False), ""))
    why = evidence(
        "item code of the report", item_code=code, item_title=title, direction=F.col("direction"), limb=F.col("limb"), predecessor_auditor=F.col("out"), predecessor_tier=F.col("out_tier"), successor_auditor=F.col("in"),
        successor_tier=F.col("in_tier"), tier_downgrade=F.col("downgrade"), disagreements_disclosed=F.col("quarrel"), successor_named=F.when(signal == "officer_departure", items.successor_named(t)),
    )
    leaves = (signal != "officer_departure") | items.officer_departure(t)
    return _event(told.filter(F.coalesce(leaves, F.lit(False))), signal, "confirmed", F.coalesce(grade, F.lit("normal")), line, truncate_words(t, 600), why)


def late_branch(found: DataFrame, documents: DataFrame) -> DataFrame:
    """Late notices, graded by what they say and how late the report is, one for each company and day."""
    late = found.filter("route = 'late'").join(documents, "accession")
    t = F.col("text")
    period = F.coalesce(items.period_on_form(t), F.col("period"))
    days = F.datediff("filed", scalars.due_date(F.when(F.datediff("filed", period) >= 20, period), F.col("form"), F.lit("small")))
    annual = F.upper(F.trim("form")).isin(*schema.ANNUAL_LATE_FORMS)
    reason = items.late_reason(t)
    grade = items.late_severity(reason, days, items.ticked(t, "significant\\s+change"), items.ticked(t, "reports\\s+been\\s+filed"), annual)
    rows = _event(late, F.lit("late_filing"), "derived", grade, F.concat_ws(" ", "company", F.lit("will file a report late")), close_quote(reason), evidence("notice of a late report", severity=grade, days_past_due_date=days))
    joint = same_day_notices(rows).select("seq", "filings_in_batch", "other_forms", F.col("headline").alias("joint"))
    told = rows.join(joint, "seq").withColumn("headline", F.col("joint"))
    with_batch = F.col("evidence").withField("filings_in_batch", F.col("filings_in_batch").cast("bigint")).withField("other_forms", F.col("other_forms"))
    return told.withColumn("evidence", with_batch).select(*rows.columns)


def letter_branch(found: DataFrame, documents: DataFrame) -> DataFrame:
    """Letters on a periodic report that ask or answer something."""
    letters = found.filter("route = 'letter'").join(documents, "accession").withColumn("subject", items.subject_line(F.col("text")))
    staff = F.upper("form").startswith("UPLOAD")
    kept = letters.filter(items.reviews_a_periodic_report(F.col("subject")) & items.admits_letter(F.col("text"), staff))
    topic = F.coalesce(F.get(items.topics(F.col("text")), 0), F.lit("its report"))
    return _event(kept, F.lit("comment_letter"), "derived", F.lit("normal"), F.concat_ws(" ", F.lit("Staff and"), "company", F.lit("write about"), mid_sentence(topic)), items.first_comment(F.col("text")), evidence("review letter", topics=items.topics(F.col("text")), citations=items.citations(F.col("text"))))


def periodic_branch(found: DataFrame, documents: DataFrame, history: DataFrame) -> DataFrame:
    """Changes of state against the company's comparable report before; only changes of today's reports come out."""
    today = found.filter("route = 'periodic'")
    now = today.join(documents, "accession").select("cik", "form", "filed", "accession", "seq", "text")
    mine = history.join(today.select("cik").distinct(), "cik", "left_semi").select(*now.columns)
    changed = changes(now.unionByName(mine)).drop("cik").withColumnsRenamed({"quote": "told", "evidence": "found"}).join(today, "accession")
    signal, e = F.col("signal_type"), F.col("found")
    words = (
        F.when(signal == "going_concern", going_concern_headline(F.col("company"), F.col("prior_state"), F.col("current_state")))
        .when(signal == "material_weakness", F.concat(F.col("company"), F.when(F.col("direction") == "weakened", " reported a material weakness").otherwise(" reported its material weakness remedied")))
        .when(signal == "policy_change", F.concat(F.col("company"), F.lit(" adopted ASU "), F.array_join(e["adopted"], ", ASU "), F.when(e["long_past"], F.concat(F.lit(", by its words in "), e["adoption_year"].cast("string"))).otherwise("")))
        .otherwise(F.concat(F.col("company"), F.lit(" rewrote its revenue policy")))
    )
    grade = F.when(F.col("direction").isin("escalated", "weakened"), "high").otherwise("normal")
    state = F.when(signal.isin("going_concern", "material_weakness"), F.col("current_state"))
    why = evidence(e["source"], direction=F.col("direction"), prior_state=F.col("prior_state"), current_state=state, similarity=e["similarity"], new_standards=e["new_standards"], adoption_year=e["adoption_year"], prior_form=e["prior_form"], prior_filed=e["prior_filed"])
    return _event(changed, signal, "derived", grade, words, F.col("told"), why, F.col("prior_accession"))


def scan(i: Inputs, log: DataFrame, tombstones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(publishable, held): all branches, tagged with the company's size; contradictory new rows are held."""
    found = candidates(i).persist()
    docs = i.documents.select("accession", "text")
    branches = item_branch(found, docs).unionByName(late_branch(found, docs)).unionByName(letter_branch(found, docs)).unionByName(periodic_branch(found, docs, i.history))
    tagged = branches.join(i.floats.select("cik", "public_float"), "cik", "left").withColumn("size_tier", scalars.size_tier(F.col("public_float"))).select(*COLUMNS, "public_float", "size_tier")
    return quality.screen(tagged, log, tombstones)


def scan_days(spark: SparkSession, data: str, log: str, date: str | None = None, days: int | None = None, most: int = MOST_PERIODIC):
    """(day, rows written, rows held) of one day, or of the newest ``days`` days of the index, oldest first.

    ``data`` holds filings, headers, documents, history, floats and tombstones; a day's periodic reports beyond ``most`` in index order
    wait. What is held goes beside the log. A day that fails the checks raises and writes nothing.
    """
    read = lambda name: table(spark, data, name)
    filings, stones = read("filings"), read("tombstones")
    if date is not None:
        wanted = [dt.date.fromisoformat(date)]
    else:
        wanted = sorted(r[0] for r in filings.select("scan_day").filter("scan_day is not null").distinct().orderBy(F.desc("scan_day")).limit(days or 1).collect())
    for day in wanted:
        today = filings.filter(F.col("scan_day") == day)
        periodic = scalars.form_route(F.col("form")) == "periodic"
        admitted = today.filter(F.coalesce(~periodic, F.lit(True))).unionByName(today.filter(periodic).orderBy("seq").limit(most))
        known = spark.read.parquet(log).select("id") if exists(spark, log) else spark.createDataFrame([], "id string")
        good, held = scan(Inputs(admitted, read("headers"), read("documents"), read("history"), read("floats")), known, stones)
        kept = land(held, "held")
        if not kept.isEmpty():
            kept.write.mode("append").parquet(f"{log.rstrip('/')}_held")
        yield day, append_events(good, log, stones), kept.count()
