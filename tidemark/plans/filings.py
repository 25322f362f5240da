"""Queries over the day index (filings) and what is read beside it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schema
from tidemark.detect import items as readers
from tidemark.functions import scalars
from tidemark.operators import series, views
from tidemark.plans.registry import query
from tidemark.session import table
from tidemark.sources import index, records


def _filings(spark, sf):
    return table(spark, sf, "filings")


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_CANDIDATES = (*schema.EVENT_FORMS, *schema.PERIODIC_FORMS, *schema.LATE_FORMS, *schema.LETTER_FORMS)
_ROUTE = f"CASE WHEN upper(trim(form)) IN {_in(schema.EVENT_FORMS)} THEN 'event' WHEN upper(trim(form)) IN {_in(schema.PERIODIC_FORMS)} THEN 'periodic' WHEN upper(trim(form)) IN {_in(schema.LATE_FORMS)} THEN 'late' WHEN upper(trim(form)) IN {_in(schema.LETTER_FORMS)} THEN 'letter' END"
_OPERATING = f"(sic IS NULL OR sic NOT IN {schema.NOT_OPERATING_SIC})"


@query(f"SELECT seq, form, cik FROM filings WHERE upper(trim(form)) IN {_in(_CANDIDATES)}")
def candidate_filter(spark, sf):
    """The cheapest test first: only forms that some branch reads."""
    return _filings(spark, sf).filter(F.upper(F.trim("form")).isin(*_CANDIDATES)).select("seq", "form", "cik")


@query(f"SELECT seq, sic FROM filings WHERE {_OPERATING}")
def operating_filter(spark, sf):
    """Unknown industries pass."""
    return _filings(spark, sf).filter(scalars.is_operating(F.col("sic"))).select("seq", "sic")


@query(f"SELECT {_ROUTE} AS route, count(*) AS filings, count(DISTINCT accession) AS accessions FROM filings GROUP BY 1")
def form_routes(spark, sf):
    return _filings(spark, sf).groupBy(scalars.form_route(F.col("form")).alias("route")).agg(F.count(F.lit(1)).alias("filings"), F.count_distinct("accession").alias("accessions"))


_DIVISION = "CASE WHEN sic IS NULL OR sic = 0 THEN '' " + " ".join(f"WHEN sic = {c} THEN '{n}'" for c, n in schema.SIC_LABELS.items()) + " " + " ".join(f"WHEN sic BETWEEN {a} AND {b} THEN '{n}'" for a, b, n in schema.SIC_DIVISIONS) + " ELSE 'SIC ' || sic END"


@query(f"SELECT sic, {_DIVISION} AS division, count(*) AS filings FROM filings GROUP BY ALL")
def sic_divisions(spark, sf):
    return _filings(spark, sf).groupBy("sic", scalars.sic_division(F.col("sic")).alias("division")).agg(F.count(F.lit(1)).alias("filings"))


@query("""
SELECT seq, array_to_string(list_distinct_ordered, ',') AS signals FROM (
  SELECT seq, list_filter(['auditor_change', 'restatement', 'officer_departure'], lambda s: false) AS x,
         list_transform(list_sort(list_transform(list_distinct(list_filter(list_transform(items, lambda i: CASE trim(i) WHEN '4.01' THEN 'auditor_change' WHEN '4.02' THEN 'restatement' WHEN '5.02' THEN 'officer_departure' END), lambda s: s IS NOT NULL)),
           lambda s: struct_pack(p := list_position(list_transform(items, lambda i: CASE trim(i) WHEN '4.01' THEN 'auditor_change' WHEN '4.02' THEN 'restatement' WHEN '5.02' THEN 'officer_departure' END), s), s := s))), lambda t: t.s) AS list_distinct_ordered
  FROM filings WHERE items IS NOT NULL)
""")
def item_signals(spark, sf):
    """The signals that a filing's item codes stand for, in their order."""
    return _filings(spark, sf).filter("items is not null").select("seq", F.array_join(scalars.item_signals(F.col("items")), ",").alias("signals"))


_BASE = "regexp_replace(upper(trim(form)), '/A$', '')"


@query(f"""
WITH f AS (SELECT seq, cik, accession, filed, {_BASE} AS base FROM filings),
     d AS (SELECT cik, base, filed, max(seq) AS s, arg_max(accession, seq) AS accession FROM f WHERE filed IS NOT NULL GROUP BY ALL),
     p AS (SELECT cik, base, filed, lag(filed) OVER w AS prior_filed, lag(accession) OVER w AS prior_accession FROM d WINDOW w AS (PARTITION BY cik, base ORDER BY filed))
SELECT f.seq, p.prior_filed, p.prior_accession FROM f LEFT JOIN p ON p.cik = f.cik AND p.base = f.base AND p.filed = f.filed
""")
def prior_comparable(spark, sf):
    """The same company's latest earlier filing of the same base form: strictly before, never of the same day."""
    f = _filings(spark, sf).select("seq", "cik", "accession", "filed", scalars.base_form(F.col("form")).alias("base"))
    return series.prior_in_series(f, ["cik", "base"], "filed", "seq", ["accession"]).select("seq", "prior_filed", "prior_accession")


@query("SELECT accession, min(seq) AS seq, count(*) AS listed FROM filings GROUP BY 1")
def relisted_filings(spark, sf):
    """Filings listed more than once, by the first listing."""
    return _filings(spark, sf).groupBy("accession").agg(F.min("seq").alias("seq"), F.count(F.lit(1)).alias("listed"))


@query(f"SELECT scan_day AS day, count(*) AS index_rows, count(*) FILTER (upper(trim(form)) IN {_in(_CANDIDATES)}) AS candidates FROM filings WHERE scan_day IS NOT NULL GROUP BY 1")
def scan_day_totals(spark, sf):
    f = _filings(spark, sf).filter("scan_day is not null")
    return f.groupBy(F.col("scan_day").alias("day")).agg(F.count(F.lit(1)).alias("index_rows"), F.count_if(F.upper(F.trim("form")).isin(*_CANDIDATES)).alias("candidates"))


@query(f"""
WITH r AS (SELECT scan_day AS day, sic IS NULL AS half, count(*) AS rows, count(*) FILTER (upper(trim(form)) IN {_in(_CANDIDATES)}) AS c FROM filings WHERE scan_day IS NOT NULL GROUP BY ALL)
SELECT day, max(rows) AS index_rows, max(c) AS candidates FROM r GROUP BY 1
""")
def scan_day_max_merge(spark, sf):
    """Two runs of a day (rows with and without an industry): each counter keeps its larger value."""
    f = _filings(spark, sf).filter("scan_day is not null")
    runs = f.groupBy(F.col("scan_day").alias("day"), F.col("sic").isNull().alias("half")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.upper(F.trim("form")).isin(*_CANDIDATES)).alias("c"))
    return views.scan_totals(runs, "day", index_rows="rows", candidates="c")


@query(f"""
WITH d AS (SELECT filed AS day, count(*) AS index_rows, count(*) FILTER (upper(trim(form)) IN {_in(_CANDIDATES)}) AS candidates FROM filings WHERE filed IS NOT NULL GROUP BY 1)
SELECT sum(index_rows)::BIGINT AS filings_scanned, sum(candidates)::BIGINT AS candidates_scanned, count(*) AS days_covered, min(day) AS first_day, max(day) AS last_day,
       (SELECT count(DISTINCT accession) FROM disclosures WHERE filed IN (SELECT day FROM d)) AS flagged_filings FROM d
""")
def scan_metrics(spark, sf):
    f = _filings(spark, sf).filter("filed is not null")
    days = f.groupBy(F.col("filed").alias("day")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.upper(F.trim("form")).isin(*_CANDIDATES)).alias("c"))
    return views.scan_metrics(table(spark, sf, "disclosures"), days, "rows", "c")


@query(f"WITH p AS (SELECT seq, scan_day, row_number() OVER (PARTITION BY scan_day ORDER BY seq) AS rank FROM filings WHERE {_ROUTE} = 'periodic') SELECT scan_day, count(*) AS periodic, count(*) FILTER (rank > 100) AS skipped FROM p GROUP BY 1")
def periodic_capacity(spark, sf):
    """Periodic reports of each day, and how many lie beyond a run's capacity of a hundred: the feature of a bounded run."""
    p = _filings(spark, sf).filter(scalars.form_route(F.col("form")) == "periodic")
    return views.cap_per_day(p, 100).groupBy("scan_day").agg(F.count(F.lit(1)).alias("periodic"), F.count_if(~F.col("admitted")).alias("skipped"))


@query("""
WITH b AS (SELECT min(filed) AS lo, max(filed) AS hi FROM filings), d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day FROM b)
SELECT day FROM d WHERE isodow(day) < 6 AND day NOT IN (SELECT filed FROM filings WHERE filed IS NOT NULL)
""")
def closed_days(spark, sf):
    """Business days of the span on which nothing was filed."""
    f = _filings(spark, sf)
    span = f.agg(F.min("filed").alias("lo"), F.max("filed").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day")).filter(F.weekday("day") < 5)
    return days.join(f.select(F.col("filed").alias("day")).distinct(), "day", "left_anti")


@query("WITH b AS (SELECT max(filed) AS hi FROM filings), d AS (SELECT unnest(generate_series(hi - 60, hi, INTERVAL 1 DAY))::DATE AS day FROM b) SELECT day, isodow(day)::INT AS weekday FROM d WHERE isodow(day) < 6 ORDER BY day LIMIT 10")
def business_days(spark, sf):
    """The oldest ten business days of the last sixty days: a bounded catch-up."""
    hi = _filings(spark, sf).agg(F.max("filed").alias("hi"))
    days = hi.select(F.explode(F.sequence(F.date_sub("hi", 60), F.col("hi"))).alias("day")).filter(F.weekday("day") < 5)
    return days.select("day", (F.weekday("day") + 1).alias("weekday")).orderBy("day").limit(10)


_KIND = f"CASE WHEN upper(trim(form)) IN {_in(schema.ANNUAL_LATE_FORMS)} THEN 90 ELSE 45 END"


@query(f"""
WITH n AS (SELECT seq, filed, CASE WHEN filed - period >= 20 THEN period END AS period, {_KIND} AS days, upper(trim(form)) IN {_in(schema.ANNUAL_LATE_FORMS)} AS annual FROM filings WHERE {_ROUTE} = 'late' AND filed IS NOT NULL),
     d AS (SELECT seq, period + days AS due, filed - (period + days) AS days_late, annual FROM n)
SELECT seq, due, days_late, CASE WHEN days_late >= 90 THEN 'high' WHEN days_late >= 30 OR annual THEN 'elevated' ELSE 'normal' END AS severity, coalesce(NOT annual AND days_late <= 3, false) AS routine FROM d
""")
def deadline_severity(spark, sf):
    """How late each notice's report is, a period under twenty days before the notice being none."""
    n = _filings(spark, sf).filter((scalars.form_route(F.col("form")) == "late") & F.col("filed").isNotNull())
    period = F.when(F.datediff("filed", "period") >= 20, F.col("period"))
    due = scalars.due_date(period, F.col("form"), F.lit("small"))
    late = F.datediff("filed", due)
    annual = F.upper(F.trim("form")).isin(*schema.ANNUAL_LATE_FORMS)
    grade = F.when(late >= 90, "high").when((late >= 30) | annual, "elevated").otherwise("normal")
    return n.select("seq", due.alias("due"), late.alias("days_late"), grade.alias("severity"), F.coalesce((grade == "normal") & (late <= 3), F.lit(False)).alias("routine"))


_LISTED = "form IS NOT NULL AND trim(form) <> '' AND company IS NOT NULL AND trim(company) <> '' AND cik IS NOT NULL AND filed IS NOT NULL"


@query(f"SELECT seq, trim(form) AS form, trim(company) AS company, cik, filed, accession FROM filings WHERE {_LISTED} UNION ALL SELECT -1, NULL, NULL, NULL, NULL, NULL WHERE false")
def form_index_scan(spark, sf):
    """The day index written in its fixed-width form and read again."""
    f = _filings(spark, sf).filter(r"form is not null and trim(form) <> '' and company is not null and trim(company) <> '' and cik is not null and filed is not null")
    line = F.concat(F.rpad(F.trim("form"), 12, " "), F.lit("  "), F.trim("company"), F.lit("   "), F.col("cik").cast("string"), F.lit("  "), F.date_format("filed", "yyyyMMdd"), F.lit("  edgar/data/"), F.col("cik").cast("string"), F.lit("/"), F.col("accession"), F.lit(".txt"))
    lines = f.select("seq", line.alias("value")).unionByName(spark.createDataFrame([(-1, "Form Type   Company Name   CIK  Date Filed  File Name"), (-1, "-----"), (-1, "no such line")], "seq long, value string"))
    return index.parse_form_index(lines).drop("path")


@query("SELECT seq, trim(form) AS form, trim(company) AS company, cik, filed, accession FROM filings WHERE form IS NOT NULL AND trim(form) <> '' AND cik IS NOT NULL AND filed IS NOT NULL AND company IS NOT NULL AND NOT contains(company, '|')")
def master_index_scan(spark, sf):
    """The day index written pipe-separated and read again."""
    f = _filings(spark, sf).filter("form is not null and trim(form) <> '' and cik is not null and filed is not null and company is not null").filter(~F.col("company").contains("|"))
    line = F.concat_ws("|", F.col("cik").cast("string"), "company", "form", F.date_format("filed", "yyyyMMdd"), F.concat(F.lit("edgar/data/"), F.col("cik").cast("string"), F.lit("/"), F.col("accession"), F.lit(".txt")))
    return index.parse_master_index(f.select("seq", line.alias("value"))).drop("path")


_IN_MASTER = "form IS NOT NULL AND trim(form) <> '' AND cik IS NOT NULL AND filed IS NOT NULL AND company IS NOT NULL AND NOT contains(company, '|')"


@query(f"""
WITH n AS (SELECT filed AS day, count(*) FILTER ({_LISTED}) AS f, count(*) FILTER ({_IN_MASTER}) AS m FROM filings WHERE filed IS NOT NULL GROUP BY 1)
SELECT day, CASE WHEN f >= 40 OR f >= m THEN 'form' ELSE 'master' END AS source, CASE WHEN f >= 40 OR f >= m THEN f ELSE m END AS rows FROM n WHERE f + m > 0
""")
def index_choice(spark, sf):
    """Of a day's two indexes, each written and read again, the fixed-width one if it is long enough, else the longer."""
    read = lambda q: q(spark, sf).select(F.col("filed").alias("day"), "seq")
    chosen = index.choose_source(read(form_index_scan), read(master_index_scan), least=40)
    return chosen.groupBy("day", "source").agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT accession, array_to_string(list_sort(list_distinct(list_filter(list_transform(items, lambda i: trim(i)), lambda i: i <> ''))), ',') AS items, sic, period FROM filings WHERE items IS NOT NULL")
def header_scan(spark, sf):
    """Filing headers written tag by tag and read again."""
    f = _filings(spark, sf).filter("items is not null")
    tag = lambda n, c: F.concat(F.lit(f"<{n}>"), c.cast("string"), F.lit("\n"))
    text = F.concat(tag("ACCESSION-NUMBER", F.col("accession")), F.coalesce(tag("PERIOD", F.date_format("period", "yyyyMMdd")), F.lit("")), F.array_join(F.transform("items", lambda i: F.concat(F.lit("<ITEMS>"), i, F.lit("\n"))), ""), F.coalesce(tag("ASSIGNED-SIC", F.col("sic")), F.lit("")))
    h = f.select("accession", *records.header_fields(text))
    return h.select("accession", F.array_join(F.array_sort(F.filter("items", lambda i: i != "")), ",").alias("items"), "sic", "period")


#: Rows of a block of a history.
BLOCK = 1_000


@query("SELECT cik, accession AS \"accessionNumber\", strftime(filed, '%Y-%m-%d') AS \"filingDate\", form FROM filings WHERE cik IN (SELECT cik FROM filings GROUP BY 1 HAVING count(*) = count(accession) AND count(*) = count(filed) AND count(*) = count(form))")
def submissions_scan(spark, sf):
    """Histories as parallel arrays, in blocks of a year and about ``BLOCK`` rows, to rows; a company with a ragged block is left out whole."""
    f = _filings(spark, sf).filter("cik is not null")
    row = F.struct("accession", "filed", "form")
    f = f.withColumn("y", F.coalesce(F.year("filed"), F.lit(-1)))
    sizes = f.groupBy("cik", "y").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("of"))
    placed = f.join(sizes, ["cik", "y"]).withColumn("block", F.pmod(F.xxhash64("seq"), "of"))
    blocks = placed.groupBy("cik", "y", "block").agg(F.collect_list(row).alias("r"))
    has = lambda c: F.transform(F.filter("r", lambda x: x[c].isNotNull()), lambda x: x[c].cast("string"))
    arrays = blocks.select("cik", has("accession").alias("accessionNumber"), has("filed").alias("filingDate"), has("form").alias("form"))
    whole = arrays.withColumn("accessionNumber", F.col("accessionNumber"))
    return records.submissions(whole, ("accessionNumber", "filingDate", "form"))


@query("WITH q AS (SELECT (date_trunc('quarter', max(filed)) - INTERVAL (3 * i) MONTH - INTERVAL 1 DAY)::DATE AS d, i FROM filings, range(0, 12) t(i) GROUP BY i) SELECT i AS id, 'CY' || year(d) || 'Q' || quarter(d) || 'I' AS frame FROM q")
def quarter_frames(spark, sf):
    today = _filings(spark, sf).agg(F.max("filed")).first()[0]
    return records.quarter_frames(spark, 12 if today else 0, str(today or "2000-01-01"))


@query("SELECT cik, max(public_float) AS public_float FROM disclosures WHERE public_float > 0 AND NOT isnan(public_float) AND cik IS NOT NULL GROUP BY 1")
def frame_union(spark, sf):
    """The largest positive value of each company over all its periods."""
    d = table(spark, sf, "disclosures").filter("cik is not null and not isnan(public_float)")
    return records.frame_values(d.select("cik", "public_float"), "cik", "public_float")


@query("""
WITH f AS (SELECT cik, max(public_float) AS public_float FROM disclosures WHERE public_float > 0 AND NOT isnan(public_float) AND cik IS NOT NULL GROUP BY 1)
SELECT seq, CASE WHEN f.public_float >= 10e9 THEN 'mega' WHEN f.public_float >= 700e6 THEN 'large' WHEN f.public_float >= 75e6 THEN 'mid' WHEN f.public_float >= 0 THEN 'small' ELSE '' END AS tier FROM filings LEFT JOIN f USING (cik)
""")
def size_tags(spark, sf):
    """Filings tagged with their company's size, the empty tier where none is known."""
    return _filings(spark, sf).select("seq", "cik").join(frame_union(spark, sf), "cik", "left").select("seq", scalars.size_tier(F.col("public_float")).alias("tier"))


_CODE_SIGNAL = "CASE c WHEN '4.01' THEN 'auditor_change' WHEN '4.02' THEN 'restatement' WHEN '5.02' THEN 'officer_departure' END"


@query(f"""
WITH i AS (SELECT seq, accession, trim(unnest(items)) AS c FROM filings WHERE upper(trim(form)) IN {_in(schema.EVENT_FORMS)}),
     s AS (SELECT accession, {_CODE_SIGNAL} AS signal_type, min(seq) AS seq, arg_min(c, struct_pack(a := seq, b := c)) AS item_code FROM i WHERE {_CODE_SIGNAL} IS NOT NULL AND accession IS NOT NULL GROUP BY ALL)
SELECT seq, substr(sha1(accession || ':' || signal_type), 1, 16) AS id, signal_type, item_code, CASE item_code WHEN '4.01' THEN 'Change of certifying accountant' WHEN '4.02' THEN 'Earlier statements not to be relied on' ELSE 'Departure of officers' END AS item_title, 'confirmed' AS confidence FROM s
""")
def item_events(spark, sf):
    """Events straight from item codes, once for each filing and signal."""
    return readers.item_events(_filings(spark, sf))


@query(f"""
WITH u AS (SELECT cik, company AS name, max(filed) AS until FROM disclosures WHERE cik IS NOT NULL AND company IS NOT NULL AND filed IS NOT NULL GROUP BY cik, company),
     n AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY until DESC, name) AS pos FROM u),
     r AS (SELECT seq, cik, filed FROM disclosures WHERE cik IS NOT NULL AND filed IS NOT NULL)
SELECT r.seq, arg_min(n.name, n.pos) AS renamed_from FROM r LEFT JOIN n ON n.cik = r.cik AND n.until BETWEEN r.filed - 30 AND r.filed GROUP BY r.seq
""")
def renamed_between(spark, sf):
    """A name that a company used last within the thirty days before an entry."""
    from pyspark.sql import Window

    d = table(spark, sf, "disclosures").filter("cik is not null and filed is not null")
    used = d.filter("company is not null").groupBy("cik", F.col("company").alias("name")).agg(F.max("filed").alias("until"))
    names = used.withColumn("pos", F.row_number().over(Window.partitionBy("cik").orderBy(F.desc("until"), "name")))
    rows = d.select("seq", "cik", F.date_sub("filed", 30).alias("lo"), F.col("filed").alias("hi"))
    return series.renamed_between(rows, names, "cik", "lo", "hi").select("seq", "renamed_from")


@query(f"""
WITH r AS (SELECT scan_day AS day, seq, sic IS NULL AS blocked, length(company) AS rows FROM filings WHERE scan_day IS NOT NULL)
SELECT day, max(seq) AS seq, arg_max(rows, seq)::INT AS rows FROM r WHERE NOT blocked GROUP BY 1
""")
def latest_runs(spark, sf):
    """The last good run of each day (rows without an industry stand for blocked runs)."""
    f = _filings(spark, sf).filter("scan_day is not null")
    runs = f.select(F.col("scan_day").alias("day"), "seq", F.col("sic").isNull().alias("blocked"), F.lit(False).alias("retryable"), F.length("company").alias("rows"))
    return series.latest_runs(runs, "day", "seq").select("day", "seq", "rows")


@query("SELECT seq, CASE WHEN filed < scan_day - 5 THEN 'fill' ELSE 'scan' END AS kind FROM filings WHERE filed IS NOT NULL AND scan_day IS NOT NULL")
def run_kinds(spark, sf):
    """Whether a day was read in time or by filling backwards."""
    return _filings(spark, sf).filter("filed is not null and scan_day is not null").select("seq", scalars.run_kind(F.col("filed"), F.col("scan_day")).alias("kind"))
