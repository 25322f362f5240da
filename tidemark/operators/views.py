"""Derived views of the event log: one DataFrame for each dataset that a page or file shows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions.scalars import form_family

MONTH = "yyyy-MM"


def last_days(events: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` filing days that occur."""
    return events.select("filed").filter("filed is not null").distinct().orderBy(F.desc("filed")).limit(n)


def activity(events: DataFrame, n: int = 20) -> DataFrame:
    """(filed, signal_type, events) over the last filing days; the days are a handful, so they are broadcast."""
    counted = events.groupBy("filed", "signal_type").agg(F.count(F.lit(1)).alias("events"))
    return counted.join(F.broadcast(last_days(events, n)), "filed", "left_semi")


def activity_pivot(events: DataFrame, n: int = 20) -> DataFrame:
    """A row for each of the last days, a column for each signal, 0 where none."""
    return activity(events, n).groupBy("filed").pivot("signal_type", list(schema.SIGNAL_ORDER)).agg(F.sum("events")).na.fill(0)


def mix(events: DataFrame, *by: str) -> DataFrame:
    """Rows of each group and its share of all rows."""
    counted = events.groupBy(*by).agg(F.count(F.lit(1)).alias("events"))
    return counted.withColumn("share", F.round(F.col("events") / F.sum("events").over(Window.partitionBy()), 6))


def severity_first(severity: str = "evidence.severity") -> Column:
    return F.when(F.col(severity) == "high", 0).otherwise(1)


def signal_weight(signal: str = "signal_type") -> Column:
    at = F.array_position(F.array(*map(F.lit, schema.SIGNAL_ORDER)), F.col(signal))
    return F.when(at > 0, at - 1).otherwise(F.lit(9))


def home_rank() -> list[Column]:
    """Newest first, severe before others, rare signals before common ones, then company from the end; arrival settles ties."""
    return [F.desc_nulls_last("filed"), severity_first().asc(), signal_weight().asc(), F.desc_nulls_last("company"), F.asc("seq")]


def scan_totals(runs: DataFrame, day: str, **largest: str) -> DataFrame:
    """For each day the largest of each counter over its runs: a run that saw less never lowers a total."""
    return runs.groupBy(day).agg(*[F.max(c).alias(n) for n, c in largest.items()])


def scan_metrics(events: DataFrame, days: DataFrame, index_rows: str, candidates: str) -> DataFrame:
    """Totals over the covered days, and the distinct filings flagged on just those days."""
    flagged = events.join(days.select(F.col("day").alias("filed")), "filed", "left_semi").agg(F.count_distinct("accession").alias("flagged_filings"))
    whole = days.agg(F.sum(index_rows).alias("filings_scanned"), F.sum(candidates).alias("candidates_scanned"), F.count(F.lit(1)).alias("days_covered"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    return whole.join(F.broadcast(flagged))  # one row beside one row


def months(days: Column) -> Column:
    """Distinct months of an array of dates, newest first, joined by commas."""
    return F.array_join(F.sort_array(F.array_distinct(F.transform(days, lambda d: F.date_format(d, MONTH))), False), ",")


def in_order(values: Column, order: tuple[str, ...]) -> Column:
    """Distinct values in display order, those without a place behind, sorted."""
    known = F.filter(F.array(*map(F.lit, order)), lambda o: F.array_contains(values, o))
    return F.array_join(F.concat(known, F.sort_array(F.array_except(values, F.array(*map(F.lit, order))))), ",")


def first_filled(value: str, *order: str) -> Column:
    """The first value in order that is neither null nor empty, else the empty string."""
    filled = (F.col(value).isNotNull()) & (F.col(value) != "")
    return F.coalesce(F.min_by(F.col(value), F.when(filled, F.struct(*order))), F.lit(""))


def directory(events: DataFrame) -> DataFrame:
    """One row for each company: newest name, first ticker and tier from the newest entry back, days, months, forms, signals.

    Everything is an aggregate: sets are of days, forms and signals, which the calendar and the lists bound.
    """
    e = events.filter("cik is not null and filed is not null").withColumn("_back", F.datediff(F.lit("9999-12-31").cast("date"), "filed")).withColumn("_family", form_family(F.col("form")))
    out = e.groupBy("cik").agg(
        F.min_by("company", F.struct("_back", "company", "seq")).alias("company"), first_filled("ticker", "_back", "seq").alias("ticker"), first_filled("size_tier", "_back", "seq").alias("size_tier"),
        F.count(F.lit(1)).alias("entries"), F.min("filed").alias("earliest"), F.max("filed").alias("latest"), F.collect_set("filed").alias("_days"), F.collect_set("_family").alias("_families"), F.collect_set("signal_type").alias("_signals"),
    )
    return out.select("cik", "company", "ticker", "size_tier", "entries", "earliest", "latest", months(F.col("_days")).alias("periods"), in_order(F.col("_families"), schema.FORM_FAMILIES).alias("families"), in_order(F.col("_signals"), schema.SIGNAL_ORDER).alias("signals"))


def newest_names(events: DataFrame) -> DataFrame:
    """(cik, company): the name on the newest row, the alphabetically first of one day."""
    e = events.filter("cik is not null and filed is not null and company is not null")
    return e.groupBy("cik").agg(F.min_by("company", F.struct(F.datediff(F.lit("9999-12-31").cast("date"), "filed"), "company")).alias("company"))


def threads(letters: DataFrame, subject: str) -> DataFrame:
    """Letters of one review as one row: company and the first sixty characters of what is reviewed."""
    e = letters.withColumn("subject", F.substring(F.coalesce(F.col(subject), F.lit("")), 1, 60)).withColumn("_family", form_family(F.col("form")))
    out = e.groupBy("cik", "subject").agg(
        F.max_by("company", F.struct("filed", "seq")).alias("company"), first_filled("ticker", "filed", "seq").alias("ticker"), first_filled("size_tier", "filed", "seq").alias("size_tier"),
        F.count(F.lit(1)).alias("letters"), F.min("filed").alias("opened"), F.max("filed").alias("closed"), F.count_if(F.upper("form").startswith("UPLOAD")).alias("from_staff"),
        F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.coalesce("evidence.topics", F.array().cast("array<string>")))))), ",").alias("topics"),
        months(F.collect_set("filed")).alias("periods"), F.array_join(F.sort_array(F.collect_set("_family")), ",").alias("families"),
    )
    return out


def topic_counts(letters: DataFrame) -> DataFrame:
    return letters.select(F.explode("evidence.topics").alias("topic")).groupBy("topic").agg(F.count(F.lit(1)).alias("letters"))


def firm_rows(events: DataFrame, key) -> DataFrame:
    """(key, name, side, downgrade, seq): the firms that events name, one row for each side that is filled."""
    one = events.select("seq", F.inline(F.array(
        F.struct(F.col("evidence.predecessor_auditor").alias("name"), F.lit("left").alias("side"), F.coalesce("evidence.tier_downgrade", F.lit(False)).alias("downgrade")),
        F.struct(F.col("evidence.successor_auditor").alias("name"), F.lit("joined").alias("side"), F.lit(False).alias("downgrade")),
    )))
    return one.filter("trim(name) <> ''").withColumn("key", key(F.col("name")))


def firm_movement(events: DataFrame, key) -> DataFrame:
    """(key, firm, left, joined, net, downgrades_from); ``firm`` is the commonest spelling, of equals the one seen first."""
    by_name = firm_rows(events, key).groupBy("key", "name").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("seq", F.when(F.col("side") == "left", 0).otherwise(1).alias("s"))).alias("first"), F.count_if(F.col("side") == "left").alias("l"), F.count_if(F.col("side") == "joined").alias("j"), F.count_if("downgrade").alias("d")
    )
    out = by_name.groupBy("key").agg(F.min_by("name", F.struct(-F.col("n"), "first")).alias("firm"), F.sum("l").alias("left"), F.sum("j").alias("joined"), F.sum("d").alias("downgrades_from"))
    return out.select("key", "firm", "left", "joined", (F.col("joined") - F.col("left")).alias("net"), "downgrades_from")


def firm_labels(events: DataFrame, key) -> DataFrame:
    """(seq, side, as_filed, firm): each name under the label of its key. Labels are one row a firm and join on the key."""
    labels = firm_movement(events, key).select("key", "firm")
    return firm_rows(events, key).join(labels, "key").select("seq", "side", F.col("name").alias("as_filed"), "firm")


def same_day_notices(late: DataFrame) -> DataFrame:
    """Late notices of one company and day as one: the severe one first, then by form and arrival.

    (cik, filed, seq, filings_in_batch, other_forms, headline)
    """
    lead = F.struct(severity_first().alias("s"), F.col("form").alias("form"), F.col("seq").alias("seq"), F.col("company").alias("company"), F.col("headline").alias("headline"))
    # counted by form first, so that what is gathered for a day is bounded by the forms there are
    by_form = late.groupBy("cik", "filed", "form").agg(F.min(lead).alias("lead"), F.count(F.lit(1)).alias("n"))
    g = by_form.groupBy("cik", "filed").agg(F.min("lead").alias("lead"), F.sum("n").alias("n"), F.collect_list(F.struct("form", "n")).alias("forms"))
    others = F.array_sort(F.transform(F.filter("forms", lambda f: (f["form"] != F.col("lead.form")) | (f["n"] > 1)), lambda f: f["form"]))
    # fixed value: the headline of several notices in one
    many = F.concat(F.col("lead.company"), F.lit(" told the SEC it could not file "), F.col("n").cast("string"), F.lit(" periodic reports on time"))
    return g.select("cik", "filed", F.col("lead.seq").alias("seq"), F.col("n").alias("filings_in_batch"), F.when(F.col("n") > 1, F.array_join(others, ",")).otherwise("").alias("other_forms"), F.when(F.col("n") > 1, many).otherwise(F.col("lead.headline")).alias("headline"))


def cap_per_day(filings: DataFrame, most: int, day: str = "scan_day", order: str = "seq") -> DataFrame:
    """Each day's rows with ``rank`` in index order and whether the day's capacity admits them: the feature of a bounded run."""
    w = Window.partitionBy(day).orderBy(order)
    return filings.withColumn("rank", F.row_number().over(w)).withColumn("admitted", F.col("rank") <= most)


def search(rows: DataFrame, signal: str | None = None, sizes: list[str] | None = None, term: str | None = None, routine: bool = True, period: str | None = None, form: str | None = None) -> DataFrame:
    """The rows that meet every condition given: one filter, which reaches the scan as far as its sources can take it."""
    tests = []
    if signal:
        tests.append(F.col("signal_type") == signal)
    if sizes:
        tests.append(F.col("size_tier").isin(sizes))
    if term:
        tests.append(F.lower(F.concat_ws(" ", "company", "ticker", "headline", "quote")).contains(term.lower()))
    if not routine:
        tests.append(~F.coalesce("routine", F.lit(False)))
    if period:
        tests.append(F.date_format("filed", "yyyy-MM-dd").startswith(period))
    if form:
        tests.append(form_family(F.col("form")) == form)
    return rows.filter(reduce(lambda a, b: a & b, tests, F.lit(True)))


def company_search(companies: DataFrame, term: str, most: int = 8) -> DataFrame:
    """The first companies whose name holds the term or whose ticker starts with it."""
    t = term.lower()
    return companies.filter(F.lower("company").contains(t) | F.lower("ticker").startswith(t)).orderBy(F.lower("company"), "cik").limit(most)


def day_axis(events: DataFrame, first: str, last: str, *tests: Column) -> DataFrame:
    """(day, events): every weekday of a span with the events that pass, empty days kept."""
    days = events.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day")).filter(F.weekday("day") < 5)
    counted = events.filter(reduce(lambda a, b: a & b, tests, F.lit(True))).groupBy(F.col("filed").alias("day")).agg(F.count(F.lit(1)).alias("events"))
    return days.join(counted, "day", "left").na.fill(0, ["events"])


def shown_evidence(evidence: Column, fields: list[str]) -> Column:
    """Evidence as readers see it: yes and no for booleans, lists joined, nulls and hidden keys left out, false and 0 kept; as JSON."""
    shown = [f for f in fields if f not in schema.HIDDEN_EVIDENCE]
    kinds = {f.name: f.dataType.simpleString() for f in schema.EVIDENCE}

    def text(f: str) -> Column:
        c = evidence[f]
        if kinds[f] == "boolean":
            return F.when(c, "Yes").when(~c, "No")
        if kinds[f].startswith("array"):
            return F.array_join(c, ", ")
        return c.cast("string")

    pairs = F.array(*[F.struct(F.lit(f).alias("k"), text(f).alias("v")) for f in sorted(shown)])
    return F.array_join(F.transform(F.filter(pairs, lambda p: p["v"].isNotNull()), lambda p: F.concat(p["k"], F.lit("="), p["v"])), "; ")
