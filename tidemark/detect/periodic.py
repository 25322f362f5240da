"""Changes of state between a periodic report and the company's comparable report before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.detect import conclusions, spans
from tidemark.functions import text
from tidemark.functions.scalars import base_form
from tidemark.operators.series import prior_in_series

SIMILARITY, LEAST_NOVEL, LEAST_NOTE, LEAST_CHARS = 0.60, 2, 400, 2_000
#: Words that a sentence on revenue policy has.
VOCABULARY = text.FLAGS + r"\b(?:revenue|customer|contract|performance\s+obligation|transaction\s+price|recogni[sz]|deliver|control)\w*"


def features(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """What each report states, read from its text once: the text itself stays behind.

    The going-concern state is the whole document's: the note's, else the text's without its risk factors. The revenue policy is
    the revenue note without the sentences every note recites; a note that ran to the limit of a note has no known end and gives none.
    """
    t = F.col("text")
    read = docs.filter(F.length("text") >= least).withColumn("note", spans.revenue_note(t)).withColumn("passage", spans.concern_passage(t))
    whole = (F.length("note") >= LEAST_NOTE) & (F.length("note") < spans.LONGEST_NOTE - 2)
    own = F.when(whole, text.drop_sentences(F.col("note"), conclusions.BOILERPLATE))
    return read.select(
        "cik", base_form(F.col("form")).alias("base"), F.upper(F.trim("form")).endswith("/A").alias("amendment"), F.col("form").alias("form"), "filed", "accession", "seq",
        F.struct(
            spans.concern_of(F.col("passage")).alias("going_concern"), conclusions.going_concern_quote(F.col("passage")).alias("quote"), spans.document_control(t).alias("control"), conclusions.standards_told(t).alias("standards"),
            own.alias("revenue"), text.shingle_hashes(text.normalise_for_diff(own)).alias("runs"), F.col("form").alias("form"), F.col("filed").cast("string").alias("filed"),
        ).alias("has"),
    )


def changes(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(cik, accession, prior_accession, signal_type, prior_state, current_state, direction, quote, evidence) of each report that differs from the one before.

    ``docs`` is (cik, form, filed, accession, seq, text), one row a report. Amendments give neither new standards nor
    states inferred from absence; unknown states are compared with nothing. Of newly named standards only those the report says
    it adopted count. A revenue policy has changed where the notes are unlike and several new sentences speak of it.
    """
    p = prior_in_series(features(docs, least), ["cik", "base"], "filed", "seq", ["accession", "has"]).filter("prior_accession is not null")
    now, was = F.col("has"), F.col("prior_has")
    gc_now, gc_was = conclusions.bucket(now["going_concern"]), conclusions.bucket(was["going_concern"])
    at = lambda c: F.array_position(F.array(*map(F.lit, conclusions.LADDER)), c)
    named = F.transform(was["standards"], lambda s: s["code"])
    fresh = F.array_sort(F.filter(now["standards"], lambda s: ~F.array_contains(named, s["code"])))
    adopted = F.filter(F.col("fresh"), lambda s: s["status"] == "adopted")
    novel = F.filter(text.novel_sentences(now["revenue"], was["runs"]), lambda s: s.rlike(VOCABULARY) & ~s.rlike(conclusions.BOILERPLATE))
    p = p.withColumn("fresh", fresh).withColumns({"adopted": adopted, "alike": F.bround(text.jaccard(now["runs"], was["runs"]), 3), "novel": novel})
    years = F.filter(F.transform("adopted", lambda s: s["year"]), lambda y: y.isNotNull())
    year = F.array_min(years)
    none = F.lit(None).cast("string")
    codes = lambda c: F.transform(c, lambda s: s["code"])

    def evidence(source: str, **own: Column) -> Column:
        kinds = {"new_standards": "array<string>", "adopted": "array<string>", "adoption_year": "int", "long_past": "boolean", "contexts": "array<string>", "similarity": "double", "new_language": "array<string>"}
        return F.struct(F.lit(source).alias("source"), *[own.get(n, F.lit(None)).cast(k).alias(n) for n, k in kinds.items()], was["form"].alias("prior_form"), was["filed"].alias("prior_filed"))

    def event(test: Column, signal: str, before: Column, after: Column, direction: Column, quote: Column, why: Column) -> Column:
        told = F.struct(F.lit(signal).alias("signal_type"), before.alias("prior_state"), after.alias("current_state"), direction.alias("direction"), quote.alias("quote"), why.alias("evidence"))
        return F.when(F.coalesce(test, F.lit(False)), told)

    long_past = year <= F.year("filed") - 2
    events = F.array(
        event((gc_now != gc_was) & ~(F.col("amendment") & (now["going_concern"] == "none") & now["quote"].isNull()), "going_concern", was["going_concern"], now["going_concern"], F.when(at(now["going_concern"]) > at(was["going_concern"]), "escalated").otherwise("eased"), F.coalesce(now["quote"], was["quote"]), evidence("going concern comparison")),
        event((now["control"] != "") & (was["control"] != "") & (now["control"] != was["control"]), "material_weakness", was["control"], now["control"], F.when(now["control"] == "material_weakness", "weakened").otherwise("remediated"), none, evidence("internal control comparison")),
        event((F.size("adopted") > 0) & ~F.col("amendment"), "policy_change", none, F.array_join(codes(F.col("adopted")), ","), none, F.get("adopted", 0)["context"], evidence("accounting standards update (ASU) reference comparison", new_standards=codes(F.col("fresh")), adopted=codes(F.col("adopted")), adoption_year=year, long_past=F.coalesce(long_past, F.lit(False)), contexts=F.slice(F.transform("adopted", lambda s: s["context"]), 1, 3))),
        event(now["revenue"].isNotNull() & was["revenue"].isNotNull() & (F.col("alike") < SIMILARITY) & (F.size("novel") >= LEAST_NOVEL), "revenue_recognition", none, F.col("alike").cast("string"), none, F.get("novel", 0), evidence("revenue recognition note comparison", similarity=F.col("alike"), new_language=F.col("novel"))),
    )
    return p.select("cik", "accession", "prior_accession", F.inline(F.filter(events, lambda e: e.isNotNull())))
