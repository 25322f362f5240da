"""Codes, dates and numbers as Catalyst expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import schema


def base_form(form: Column) -> Column:
    """The form without its amendment mark."""
    return F.regexp_replace(F.upper(F.trim(form)), "/A$", "")


def form_family(form: Column) -> Column:
    """NT for every late notice, LETTER for correspondence, 20-F for 40-F too, else the form before its slash; OTHER for blank."""
    f = F.upper(F.trim(F.coalesce(form, F.lit(""))))
    head = F.trim(F.substring_index(f, "/", 1))
    return (
        F.when(f.startswith("NT "), "NT").when(head.isin(*schema.LETTER_FORMS), "LETTER").when(head.isin("20-F", "40-F"), "20-F").when(head == "", "OTHER").otherwise(head)
    )


def form_route(form: Column) -> Column:
    """Which branch reads the form: event, periodic, late, letter, or null for none."""
    f = F.upper(F.trim(form))
    return F.when(f.isin(*schema.EVENT_FORMS), "event").when(f.isin(*schema.PERIODIC_FORMS), "periodic").when(f.isin(*schema.LATE_FORMS), "late").when(f.isin(*schema.LETTER_FORMS), "letter")


def is_operating(sic: Column) -> Column:
    """Unknown industries pass."""
    return sic.isNull() | ~sic.isin(*schema.NOT_OPERATING_SIC)


def item_signals(items: Column) -> Column:
    """The signals that item codes stand for, in order, each once."""
    named = F.transform(items, lambda i: reduce(lambda w, kv: w.when(F.trim(i) == kv[0], kv[1]), schema.ITEM_SIGNALS.items(), F.when(F.lit(False), "")))
    return F.array_distinct(F.filter(named, lambda s: s.isNotNull()))


def sic_division(sic: Column) -> Column:
    """The label of an industry code: its own where it has one, else its division's, ``SIC n`` in the gaps, empty for null and 0."""
    named = reduce(lambda w, kv: w.when(sic == kv[0], kv[1]), schema.SIC_LABELS.items(), F.when(sic.isNull() | (sic == 0), ""))
    inside = reduce(lambda w, d: w.when(sic.between(d[0], d[1]), d[2]), schema.SIC_DIVISIONS, named)
    return inside.otherwise(F.concat(F.lit("SIC "), sic.cast("string")))


def size_tier(public_float: Column) -> Column:
    return reduce(lambda w, t: w.when(public_float >= t[0], t[1]), schema.SIZE_TIERS, F.when(public_float.isNull() | F.isnan(public_float), "")).otherwise("")


def plausible_float(public_float: Column, assets: Column, shares: Column) -> Column:
    """Under ten trillion, at most a hundred times the assets, at most 10,000 a share; unknown or zero assets and shares pass."""
    fits = F.coalesce((assets == 0) | (public_float <= assets * 100), F.lit(True))
    price = F.coalesce((shares == 0) | (public_float <= shares * 10_000), F.lit(True))
    return (public_float > 0) & (public_float < 1e13) & fits & price


def event_id(accession: Column, signal: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws(":", accession, signal)), 1, 16)


def filing_url(cik: Column, accession: Column, root: str = "https://filings.example/archive") -> Column:
    return F.concat(F.lit(root + "/"), cik.cast("string"), F.lit("/"), F.translate(accession, "-", ""), F.lit("/"), accession, F.lit("-index.htm"))


def iso_date(yyyymmdd: Column) -> Column:
    """A date from eight digits; null for what is none."""
    return F.when(yyyymmdd.rlike("^[0-9]{8}$"), F.try_to_date(yyyymmdd, "yyyyMMdd"))


def upper_median(values: Column) -> Column:
    """The middle of the sorted values, the upper one of two."""
    known = F.sort_array(F.filter(values, lambda v: v.isNotNull()))
    return F.get(known, F.floor(F.size(known) / 2).cast("int"))


def weekdays_between(after: Column, upto: Column) -> Column:
    """Mondays to Fridays after one date up to another, by arithmetic on whole weeks; 0 where the second is not later."""
    days = F.greatest(F.datediff(upto, after), F.lit(0))
    first = F.weekday(F.date_add(after, 1))
    rest = F.pmod(days, F.lit(7))
    weekend = F.size(F.filter(F.sequence(F.lit(0), F.lit(6)), lambda i: (i < rest) & (F.pmod(first + i, F.lit(7)) >= 5)))
    return F.when(days > 0, F.floor(days / 7) * 5 + rest - weekend).otherwise(F.lit(0)).cast("int")


def due_date(period: Column, form: Column, tier: Column) -> Column:
    """The statutory date of the report a notice defers; the small schedule where the tier is unknown."""
    bucket = F.when(tier.isin("mega", "large"), "large").when(tier == "mid", "mid").otherwise("small")
    annual = F.upper(F.trim(form)).isin(*schema.ANNUAL_LATE_FORMS)
    days = F.when(F.lit(False), 0)
    for kind, by in schema.DUE_DAYS.items():
        for name, n in by.items():
            days = days.when((annual if kind == "annual" else ~annual) & (bucket == name), n)
    return F.date_add(period, days)


def last_complete_day(now_utc: Column, zone: str = "America/New_York", hour: int = 23) -> Column:
    """Today where the local clock has passed the hour of publication, else yesterday."""
    local = F.from_utc_timestamp(now_utc, zone)
    return F.when(F.hour(local) >= hour, F.to_date(local)).otherwise(F.date_sub(F.to_date(local), 1))


def lateness(behind: Column) -> Column:
    return F.when(behind <= 0, "current").otherwise(F.concat(behind.cast("string"), F.lit(" business day"), F.when(behind == 1, "").otherwise("s"), F.lit(" behind")))


def percent(part: Column, whole: Column) -> Column:
    """Whole percent rounded half to even; a dash without a whole."""
    return F.when(whole > 0, F.concat(F.bround(100.0 * part / whole, 0).cast("int").cast("string"), F.lit("%"))).otherwise("—")


def figure(n: Column) -> Column:
    """Separators below a million, three significant figures above; a dash for null."""
    size = F.abs(n)
    out = F.when(n.isNull(), "—")
    for cut, suffix in ((1e12, "T"), (1e9, "B"), (1e6, "M")):
        scaled = size / cut
        text = F.when(scaled < 10, F.format_number(scaled, 2)).when(scaled < 100, F.format_number(scaled, 1)).otherwise(F.translate(F.format_number(scaled, 0), ",", ""))
        out = out.when(size >= cut, F.concat(F.when(n < 0, "-").otherwise(""), text, F.lit(suffix)))
    return out.otherwise(F.concat(F.when(n < 0, "-").otherwise(""), F.format_number(size, 0)))


def money(n: Column) -> Column:
    return F.when(n.isNull(), "").when(n >= 1e9, F.concat(F.lit("$"), F.format_number(n / 1e9, 1), F.lit("B"))).otherwise(F.concat(F.lit("$"), F.translate(F.format_number(n / 1e6, 0), ",", ""), F.lit("M")))


def rfc822(day: Column) -> Column:
    return F.date_format(day, "EEE, dd MMM yyyy '00:00:00 +0000'")


def verified_tier(public_float: Column, own_assets: Column) -> Column:
    """The tier; the two upper ones only where the value is at most a hundred times the company's own assets (unknown assets pass)."""
    tier = size_tier(public_float)
    doubtful = tier.isin("mega", "large") & F.coalesce((own_assets > 0) & (public_float > own_assets * 100), F.lit(False))
    return F.when(doubtful, "").otherwise(tier)


def run_kind(day: Column, finished: Column) -> Column:
    """fill where a run read a day more than five days before it finished, else scan."""
    return F.when(day < F.date_sub(F.to_date(finished), 5), "fill").otherwise("scan")
