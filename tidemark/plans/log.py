"""Queries over the event log (disclosures, holds, tombstones)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import quality, schema
from tidemark.functions import scalars, text
from tidemark.operators import dedupe, followon, firms, sequences, series, views
from tidemark.plans.registry import plain_sql, query
from tidemark.session import table
from tidemark.sinks import exists, feed_items, year_index
from tidemark.sources.records import newest_first

# Parts that several queries share.
_FAMILY = """CASE WHEN upper(trim(coalesce({c}, ''))) LIKE 'NT %' THEN 'NT'
     WHEN trim(split_part(upper(trim(coalesce({c}, ''))), '/', 1)) IN ('UPLOAD', 'CORRESP') THEN 'LETTER'
     WHEN trim(split_part(upper(trim(coalesce({c}, ''))), '/', 1)) IN ('20-F', '40-F') THEN '20-F'
     WHEN trim(split_part(upper(trim(coalesce({c}, ''))), '/', 1)) = '' THEN 'OTHER'
     ELSE trim(split_part(upper(trim(coalesce({c}, ''))), '/', 1)) END"""
_WEIGHT = "CASE signal_type " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(schema.SIGNAL_ORDER)) + " ELSE 9 END"
_SEVERE = "CASE WHEN evidence.severity = 'high' THEN 0 ELSE 1 END"


def _log(spark, sf):
    return table(spark, sf, "disclosures")


def _pairs_sql(src: str, pairs, days: int) -> str:
    values = ", ".join(f"('{a}', '{b}')" for a, b in pairs)
    return f"""
WITH e AS ({src}), o AS (SELECT max(day) AS as_of FROM e), p(first, second) AS (VALUES {values}),
     f AS (SELECT p.first, p.second, e.entity, min(e.day) AS d FROM p JOIN e ON e.kind = p.first GROUP BY ALL),
     x AS (SELECT f.*, o.as_of - f.d >= {days} AS mature,
                  EXISTS (SELECT 1 FROM e WHERE e.entity = f.entity AND e.kind = f.second AND e.day - f.d BETWEEN 1 AND {days}) AS hit FROM f, o),
     a AS (SELECT p.first, p.second, count(x.entity) AS with_first, count(*) FILTER (x.mature) AS eligible, count(*) FILTER (NOT x.mature) AS immature,
                  count(*) FILTER (x.mature AND x.hit) AS followed FROM p LEFT JOIN x ON x.first = p.first AND x.second = p.second GROUP BY ALL)
SELECT *, CASE WHEN eligible > 0 THEN round_even(100.0 * followed / eligible, 0)::INT || '%' ELSE '—' END AS rate FROM a
"""


@query(_pairs_sql("SELECT cik AS entity, signal_type AS kind, filed AS day FROM disclosures WHERE cik IS NOT NULL AND filed IS NOT NULL", schema.FOLLOW_ON_PAIRS, schema.FOLLOW_ON_DAYS))
def followon_rates(spark, sf):
    """Of the companies with one kind of event, how many had another within 540 days."""
    e = _log(spark, sf)
    as_of = F.lit(e.agg(F.max("filed")).first()[0])
    return followon.follow_on(e, "cik", "signal_type", "filed", list(schema.FOLLOW_ON_PAIRS), schema.FOLLOW_ON_DAYS, as_of)


@query("SELECT signal_type AS kind, count(*) AS events, count(DISTINCT cik) AS companies FROM disclosures GROUP BY 1")
def followon_counts(spark, sf):
    return _log(spark, sf).groupBy(F.col("signal_type").alias("kind")).agg(F.count(F.lit(1)).alias("events"), F.count_distinct("cik").alias("companies"))


_SEQUENCES = """
WITH e AS (SELECT cik AS entity, signal_type AS kind, filed AS day, accession AS filing, form, seq FROM disclosures WHERE cik IS NOT NULL AND filed IS NOT NULL AND signal_type IS NOT NULL),
     a AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY entity, kind ORDER BY day, seq, filing) = 1),
     b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY entity, coalesce(filing, '#' || seq) ORDER BY day, seq) = 1),
     c AS (SELECT *, regexp_replace(upper(form), '[/A]+$', '') AS bare, row_number() OVER (PARTITION BY entity ORDER BY day, seq) AS pos FROM b),
     w(notice, report, days) AS (VALUES ('NT 10-Q', '10-Q', 10), ('NT 10-K', '10-K', 25), ('NT 20-F', '20-F', 25)),
     d AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM w JOIN c o ON o.entity = c.entity AND o.pos > c.pos AND o.bare = w.report AND o.day - c.day BETWEEN 0 AND w.days WHERE w.notice = c.bare)),
     s AS (SELECT entity, row_number() OVER o AS step, kind, day, filing, day - lag(day) OVER o AS days_since_previous, count(*) OVER (PARTITION BY entity) AS steps,
                  max(day) OVER (PARTITION BY entity) - min(day) OVER (PARTITION BY entity) AS span_days FROM d WINDOW o AS (PARTITION BY entity ORDER BY day, seq))
"""


@query(_SEQUENCES + "SELECT * FROM s WHERE steps >= 2")
def company_sequence(spark, sf):
    return sequences.entity_sequences(_log(spark, sf))


@query(_SEQUENCES + "SELECT s.entity, any_value(n.company) AS company, max(steps) AS steps, max(span_days) AS span_days FROM s JOIN (SELECT cik, arg_min(company, struct_pack(a := -epoch(filed), b := company)) AS company FROM disclosures WHERE filed IS NOT NULL GROUP BY 1) n ON n.cik = s.entity WHERE steps >= 2 GROUP BY s.entity ORDER BY steps DESC, company, s.entity LIMIT 120")
def top_sequences(spark, sf):
    """The 120 longest sequences."""
    e = _log(spark, sf)
    per = sequences.entity_sequences(e).groupBy("entity").agg(F.max("steps").alias("steps"), F.max("span_days").alias("span_days"))
    return per.join(views.newest_names(e).withColumnRenamed("cik", "entity"), "entity").select("entity", "company", "steps", "span_days").orderBy(F.desc("steps"), "company", "entity").limit(120)


@query("""
WITH late AS (SELECT seq, cik, filed, regexp_replace(upper(form), '[/A]+$', '') AS form FROM disclosures WHERE signal_type = 'late_filing'),
     w(notice, report, days) AS (VALUES ('NT 10-Q', '10-Q', 10), ('NT 10-K', '10-K', 25), ('NT 20-F', '20-F', 25))
SELECT seq FROM late WHERE NOT EXISTS (SELECT 1 FROM w JOIN disclosures d ON d.cik = late.cik AND regexp_replace(upper(d.form), '[/A]+$', '') = w.report AND d.filed - late.filed BETWEEN 0 AND w.days WHERE w.notice = late.form)
""")
def extension_antijoin(spark, sf):
    """Late notices that no report answered within its window. The right side is first made one row a company, form and day."""
    bare = F.regexp_replace(F.upper("form"), "[/A]+$", "")
    e = _log(spark, sf).withColumn("form", bare)
    late = e.filter("signal_type = 'late_filing'").select("seq", "cik", "filed", "form")
    wanted = F.create_map(*[F.lit(x) for k, (r, _) in schema.EXTENSION_WINDOWS.items() for x in (k, r)])
    days = F.create_map(*[F.lit(x) for k, (_, n) in schema.EXTENSION_WINDOWS.items() for x in (k, n)])
    notices = late.withColumn("report", F.try_element_at(wanted, F.col("form"))).withColumn("days", F.try_element_at(days, F.col("form")))
    reports = e.select("cik", F.col("form").alias("report"), F.col("filed").alias("on")).filter(F.col("report").isin([r for r, _ in schema.EXTENSION_WINDOWS.values()])).distinct()
    near = F.datediff(F.col("r.on"), F.col("n.filed")).between(0, F.col("n.days"))
    return notices.alias("n").join(reports.alias("r"), (F.col("n.cik") == F.col("r.cik")) & (F.col("n.report") == F.col("r.report")) & near, "left_anti").select("seq")


@query(f"""
WITH l AS (SELECT *, {_SEVERE} AS sev FROM disclosures WHERE signal_type = 'late_filing'),
     r AS (SELECT *, row_number() OVER (PARTITION BY cik, filed ORDER BY sev, form, seq) AS rn, count(*) OVER (PARTITION BY cik, filed) AS n FROM l)
SELECT a.cik, a.filed, a.seq, a.n AS filings_in_batch,
       coalesce((SELECT string_agg(DISTINCT b.form, ',' ORDER BY b.form) FROM r b WHERE b.cik = a.cik AND b.filed IS NOT DISTINCT FROM a.filed AND b.rn > 1), '') AS other_forms,
       CASE WHEN a.n > 1 THEN a.company || ' told the SEC it could not file ' || a.n || ' periodic reports on time' ELSE a.headline END AS headline
FROM r a WHERE rn = 1
""")
def same_day_merge(spark, sf):
    return views.same_day_notices(_log(spark, sf).filter("signal_type = 'late_filing'"))


@query("SELECT seq, substr(sha1(accession || ':' || signal_type), 1, 16) AS id, id = substr(sha1(accession || ':' || signal_type), 1, 16) AS as_stored FROM disclosures")
def event_ids(spark, sf):
    e = _log(spark, sf)
    made = scalars.event_id(F.col("accession"), F.col("signal_type"))
    return e.select("seq", made.alias("id"), (F.col("id") == made).alias("as_stored"))


@query("""
WITH last AS (SELECT max(scan_day) AS d FROM disclosures), b AS (SELECT * FROM disclosures, last WHERE scan_day = d), l AS (SELECT id FROM disclosures, last WHERE scan_day < d)
SELECT min(seq) AS seq, id FROM b WHERE id NOT IN (SELECT id FROM l WHERE id IS NOT NULL) AND id NOT IN (SELECT event_id FROM tombstones WHERE action = 'withdraw' AND event_id IS NOT NULL) GROUP BY id
""")
def idempotent_append(spark, sf):
    """What the last batch adds to the log before it: once an id, on no other day, not withdrawn."""
    e = _log(spark, sf)
    last = e.agg(F.max("scan_day")).first()[0]
    fresh = dedupe.new_events(e.filter(F.col("scan_day") == last), e.filter(F.col("scan_day") < last), table(spark, sf, "tombstones"))
    return fresh.select("seq", "id")


@query("SELECT min(seq) AS seq, id, count(*) AS listed FROM disclosures GROUP BY id")
def relisted_dedupe(spark, sf):
    """The first row of each id over all days, however late the others come."""
    return _log(spark, sf).groupBy("id").agg(F.min("seq").alias("seq"), F.count(F.lit(1)).alias("listed"))


@query("SELECT seq, id FROM disclosures WHERE id NOT IN (SELECT event_id FROM tombstones WHERE action = 'withdraw' AND event_id IS NOT NULL)")
def tombstone_antijoin(spark, sf):
    return _log(spark, sf).join(dedupe.withdrawn(table(spark, sf, "tombstones")), "id", "left_anti").select("seq", "id")


@query("SELECT event_id, action, count(*) AS n FROM tombstones WHERE action = 'withdraw' GROUP BY ALL")
def tombstones_read(spark, sf):
    return table(spark, sf, "tombstones").filter("action = 'withdraw'").groupBy("event_id", "action").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT form, {_FAMILY.format(c='form')} AS family, regexp_replace(upper(trim(form)), '/A$', '') AS base, count(*) AS n FROM disclosures GROUP BY ALL")
def form_family(spark, sf):
    f = F.col("form")
    return _log(spark, sf).groupBy("form", scalars.form_family(f).alias("family"), scalars.base_form(f).alias("base")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT seq, CASE WHEN public_float >= 10e9 THEN 'mega' WHEN public_float >= 700e6 THEN 'large' WHEN public_float >= 75e6 THEN 'mid' WHEN public_float >= 0 THEN 'small' ELSE '' END AS tier,
       public_float > 0 AND public_float < 1e13 AS plausible FROM disclosures WHERE public_float IS NOT NULL AND NOT isnan(public_float)
""")
def size_tier(spark, sf):
    e = _log(spark, sf).filter("public_float is not null and not isnan(public_float)")
    f = F.col("public_float")
    return e.select("seq", scalars.size_tier(f).alias("tier"), scalars.plausible_float(f, F.lit(None).cast("double"), F.lit(None).cast("double")).alias("plausible"))


@query("WITH d AS (SELECT DISTINCT filed FROM disclosures WHERE filed IS NOT NULL ORDER BY filed DESC LIMIT 20) SELECT filed, signal_type, count(*) AS events FROM disclosures WHERE filed IN (SELECT filed FROM d) GROUP BY ALL")
def activity_by_day(spark, sf):
    return views.activity(_log(spark, sf))


@query("WITH d AS (SELECT DISTINCT filed FROM disclosures WHERE filed IS NOT NULL ORDER BY filed DESC LIMIT 20) SELECT filed, " + ", ".join(f"count(*) FILTER (signal_type = '{s}') AS {s}" for s in schema.SIGNAL_ORDER) + " FROM disclosures WHERE filed IN (SELECT filed FROM d) GROUP BY filed")
def activity_pivot(spark, sf):
    return views.activity_pivot(_log(spark, sf))


@query("SELECT signal_type, count(*) AS events, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM disclosures GROUP BY 1")
def signal_mix(spark, sf):
    return views.mix(_log(spark, sf), "signal_type")


@query("SELECT size_tier, evidence.severity AS severity, count(*) AS events, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM disclosures GROUP BY ALL")
def severity_mix(spark, sf):
    return views.mix(_log(spark, sf).select("size_tier", F.col("evidence.severity").alias("severity")), "size_tier", "severity")


@query("SELECT count(DISTINCT (cik, filed)) AS situations, count(*) FILTER (routine) AS routine, count(DISTINCT cik) AS companies, count(DISTINCT filed) AS days, count(DISTINCT signal_type) AS signals FROM disclosures WHERE filed IS NOT NULL")
def distinct_situations(spark, sf):
    e = _log(spark, sf).filter("filed is not null")
    return e.agg(F.count_distinct("cik", "filed").alias("situations"), F.count_if("routine").alias("routine"), F.count_distinct("cik").alias("companies"), F.count_distinct("filed").alias("days"), F.count_distinct("signal_type").alias("signals"))


@query("SELECT unnest(evidence.topics) AS topic, count(*) AS letters FROM disclosures WHERE signal_type = 'comment_letter' GROUP BY 1")
def topic_counts(spark, sf):
    return views.topic_counts(_log(spark, sf).filter("signal_type = 'comment_letter'"))


@query("""
WITH l AS (SELECT signal_type, scan_day - filed AS lag FROM disclosures WHERE filed IS NOT NULL AND scan_day IS NOT NULL)
SELECT signal_type, count(*) AS rows, min(lag) AS min_lag, max(lag) AS max_lag, list_sort(list(lag))[len(list(lag)) // 2 + 1] AS median_lag FROM l GROUP BY 1
""")
def publication_lag(spark, sf):
    """Days from filing to scan, with the upper median. Lags are counted first, so the median sorts distinct values, not rows."""
    lag = _log(spark, sf).filter("filed is not null and scan_day is not null").groupBy("signal_type", F.datediff("scan_day", "filed").alias("lag")).agg(F.count(F.lit(1)).alias("n"))
    per = lag.groupBy("signal_type").agg(F.sum("n").alias("rows"), F.min("lag").alias("min_lag"), F.max("lag").alias("max_lag"), F.sort_array(F.collect_list(F.struct("lag", "n"))).alias("h"))
    walk = F.aggregate("h", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("at")), lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"), F.when(a["at"].isNull() & (a["seen"] + x["n"] > F.floor(F.col("rows") / 2)), x["lag"]).otherwise(a["at"]).alias("at")))
    return per.select("signal_type", "rows", "min_lag", "max_lag", walk["at"].alias("median_lag"))


@query(f"""
WITH l AS (SELECT *, substr(coalesce(prior_accession, ''), 1, 60) AS subject FROM disclosures WHERE signal_type = 'comment_letter' AND filed IS NOT NULL)
SELECT cik, subject, arg_max(company, struct_pack(a := filed, b := seq)) AS company,
       coalesce(arg_min(ticker, struct_pack(a := filed, b := seq)) FILTER (ticker <> ''), '') AS ticker, coalesce(arg_min(size_tier, struct_pack(a := filed, b := seq)) FILTER (size_tier <> ''), '') AS size_tier,
       count(*) AS letters, min(filed) AS opened, max(filed) AS closed, count(*) FILTER (upper(form) LIKE 'UPLOAD%') AS from_staff,
       array_to_string(list_sort(list_distinct(flatten(list(coalesce(evidence.topics, []))))), ',') AS topics,
       array_to_string(list_reverse_sort(list_distinct(list(strftime(filed, '%Y-%m')))), ',') AS periods, string_agg(DISTINCT {_FAMILY.format(c='form')}, ',' ORDER BY {_FAMILY.format(c='form')}) AS families
FROM l GROUP BY cik, subject
""")
def letter_threads(spark, sf):
    return views.threads(_log(spark, sf).filter("signal_type = 'comment_letter' and filed is not null"), "prior_accession")


def _ordered(col: str, order) -> str:
    known = ", ".join(f"'{o}'" for o in order)
    return f"array_to_string(list_filter([{known}], lambda o: list_contains({col}, o)) || list_sort(list_filter({col}, lambda o: NOT list_contains([{known}], o))), ',')"


@query(f"""
WITH e AS (SELECT *, {_FAMILY.format(c='form')} AS family FROM disclosures WHERE cik IS NOT NULL AND filed IS NOT NULL),
     g AS (SELECT cik, arg_min(company, struct_pack(a := -epoch(filed), b := company, c := seq)) AS company,
                  coalesce(arg_min(ticker, struct_pack(a := -epoch(filed), b := seq)) FILTER (ticker <> ''), '') AS ticker, coalesce(arg_min(size_tier, struct_pack(a := -epoch(filed), b := seq)) FILTER (size_tier <> ''), '') AS size_tier,
                  count(*) AS entries, min(filed) AS earliest, max(filed) AS latest, list_distinct(list(strftime(filed, '%Y-%m'))) AS m, list_distinct(list(family)) AS f, list_distinct(list(signal_type)) AS s FROM e GROUP BY cik)
SELECT cik, company, ticker, size_tier, entries, earliest, latest, array_to_string(list_reverse_sort(m), ',') AS periods, {_ordered('f', schema.FORM_FAMILIES)} AS families, {_ordered('s', schema.SIGNAL_ORDER)} AS signals FROM g
""")
def company_directory(spark, sf):
    return views.directory(_log(spark, sf))


_FIRMS = f"""
WITH n AS (SELECT seq, evidence.predecessor_auditor AS name, 'left' AS side, coalesce(evidence.tier_downgrade, false) AS downgrade FROM disclosures
           UNION ALL SELECT seq, evidence.successor_auditor, 'joined', false FROM disclosures),
     k AS (SELECT *, {firms.KEY_SQL} AS key FROM n WHERE trim(name) <> ''),
     b AS (SELECT key, name, count(*) AS n, min(struct_pack(a := seq, b := CASE side WHEN 'left' THEN 0 ELSE 1 END)) AS f, count(*) FILTER (side = 'left') AS l, count(*) FILTER (side = 'joined') AS j, count(*) FILTER (downgrade) AS d FROM k GROUP BY ALL),
     m AS (SELECT key, arg_min(name, struct_pack(a := -n, b := f)) AS firm, sum(l)::BIGINT AS "left", sum(j)::BIGINT AS joined, sum(j)::BIGINT - sum(l)::BIGINT AS net, sum(d)::BIGINT AS downgrades_from FROM b GROUP BY key)
"""


@query(_FIRMS + "SELECT * FROM m")
def firm_movement(spark, sf):
    return views.firm_movement(_log(spark, sf), firms.firm_key)


@query(_FIRMS + "SELECT seq, side, name AS as_filed, firm FROM k JOIN m USING (key)")
def firm_label_mode(spark, sf):
    return views.firm_labels(_log(spark, sf), firms.firm_key)


@query("SELECT cik, arg_min(company, struct_pack(a := -epoch(filed), b := company)) AS company FROM disclosures WHERE cik IS NOT NULL AND filed IS NOT NULL AND company IS NOT NULL GROUP BY 1")
def newest_name(spark, sf):
    return views.newest_names(_log(spark, sf))


@query(f"SELECT seq, filed, signal_type, company FROM disclosures ORDER BY filed DESC NULLS LAST, {_SEVERE}, {_WEIGHT}, company DESC NULLS LAST, seq LIMIT 150")
def home_window(spark, sf):
    return _log(spark, sf).orderBy(*views.home_rank()).limit(150).select("seq", "filed", "signal_type", "company")


@query("SELECT seq, signal_type, filed, row_number() OVER (PARTITION BY signal_type ORDER BY filed DESC NULLS LAST, company DESC NULLS LAST, seq) AS rank FROM disclosures QUALIFY rank <= 12")
def topk_per_signal(spark, sf):
    top = series.top_per_group(_log(spark, sf), ["signal_type"], 12, F.desc_nulls_last("filed"), F.desc_nulls_last("company"), F.asc("seq"))
    return top.select("seq", "signal_type", "filed", "rank")


@query("SELECT id AS guid, headline AS title, filing_url AS link, strftime(filed, '%a, %d %b %Y 00:00:00 +0000') AS published, coalesce(evidence.why, '') AS description, seq FROM disclosures ORDER BY filed DESC NULLS LAST, company DESC NULLS LAST, seq LIMIT 60")
def feed(spark, sf):
    return feed_items(_log(spark, sf))


@query("SELECT seq, filed, company FROM disclosures ORDER BY filed DESC NULLS LAST, company DESC NULLS LAST, seq")
def log_newest_first(spark, sf):
    return newest_first(_log(spark, sf)).select("seq", "filed", "company")


@query("WITH m AS (SELECT DISTINCT year(filed) AS year, strftime(filed, '%Y-%m') AS m FROM disclosures WHERE filed IS NOT NULL) SELECT year, string_agg(m, ',' ORDER BY m DESC) AS months FROM m GROUP BY 1")
def periods_by_year(spark, sf):
    return _log(spark, sf).filter("filed is not null").groupBy(F.year("filed").alias("year")).agg(views.months(F.collect_set("filed")).alias("months"))


@query("SELECT year(filed) AS year, count(*) AS events FROM disclosures WHERE filed IS NOT NULL GROUP BY 1")
def year_partition(spark, sf):
    return year_index(_log(spark, sf))


@query(f"SELECT {_FAMILY.format(c='form')} AS family, count(*) AS entries, count(DISTINCT cik) AS companies FROM disclosures GROUP BY 1")
def families_present(spark, sf):
    return _log(spark, sf).groupBy(scalars.form_family(F.col("form")).alias("family")).agg(F.count(F.lit(1)).alias("entries"), F.count_distinct("cik").alias("companies"))


@query("""
SELECT seq, (SELECT count(*) FROM range(0, greatest(scan_day - filed, 0)) r(i) WHERE isodow(filed + 1 + i::INT) < 6)::INT AS behind FROM disclosures WHERE filed IS NOT NULL AND scan_day IS NOT NULL
""")
def days_behind(spark, sf):
    """Business days from filing to scan."""
    return _log(spark, sf).filter("filed is not null and scan_day is not null").select("seq", scalars.weekdays_between(F.col("filed"), F.col("scan_day")).alias("behind"))


@query("""
SELECT severity, routine, lateness, count(*) AS n FROM (
  SELECT evidence.severity AS severity, coalesce(routine, false) AS routine, CASE WHEN evidence.days_past_due_date >= 90 THEN 'high' WHEN evidence.days_past_due_date >= 30 THEN 'elevated' WHEN evidence.days_past_due_date <= 3 THEN 'routine' ELSE 'normal' END AS lateness
  FROM disclosures WHERE signal_type = 'late_filing') GROUP BY ALL
""")
def lateness_grades(spark, sf):
    d = F.col("evidence.days_past_due_date")
    grade = F.when(d >= 90, "high").when(d >= 30, "elevated").when(d <= 3, "routine").otherwise("normal")
    return _log(spark, sf).filter("signal_type = 'late_filing'").groupBy(F.col("evidence.severity").alias("severity"), F.coalesce("routine", F.lit(False)).alias("routine"), grade.alias("lateness")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT seq, evidence.prior_state AS prior_state, evidence.current_state AS current_state,
       CASE WHEN list_position(['none', 'risk', 'alleviated', 'doubt'], evidence.current_state) > list_position(['none', 'risk', 'alleviated', 'doubt'], evidence.prior_state) THEN 'escalated' ELSE 'eased' END AS direction
FROM disclosures WHERE evidence.prior_state <> evidence.current_state
""")
def state_transitions(spark, sf):
    e = _log(spark, sf).select("seq", "evidence.prior_state", "evidence.current_state")
    return series.transitions(e, "current_state", "prior_state", ["none", "risk", "alleviated", "doubt"])


@query("""
WITH e AS (SELECT seq, cik, filed, evidence.new_standards AS s FROM disclosures WHERE signal_type = 'policy_change'),
     d AS (SELECT cik, filed, arg_max(s, seq) AS s FROM (SELECT cik, filed, seq, coalesce(s, []) AS s FROM e) WHERE filed IS NOT NULL GROUP BY ALL),
     p AS (SELECT cik, filed, lag(s) OVER (PARTITION BY cik ORDER BY filed) AS p FROM d)
SELECT e.seq, array_to_string(list_sort(list_filter(list_distinct(coalesce(e.s, [])), lambda x: NOT list_contains(coalesce(p.p, []), x))), ',') AS new_codes FROM e LEFT JOIN p ON p.cik = e.cik AND p.filed = e.filed
""")
def newly_cited_codes(spark, sf):
    """Standards a company cites that its report before did not."""
    e = _log(spark, sf).filter("signal_type = 'policy_change'").select("seq", "cik", "filed", F.coalesce("evidence.new_standards", F.array().cast("array<string>")).alias("codes"))
    p = series.prior_in_series(e, ["cik"], "filed", "seq", ["codes"])
    return p.select("seq", F.array_join(series.new_elements(p, "codes", "prior_codes"), ",").alias("new_codes"))


_SEARCH = "lower(concat_ws(' ', company, ticker, headline, quote))"


@query(f"SELECT seq FROM disclosures WHERE signal_type = 'going_concern' AND size_tier IN ('small', 'mid') AND contains({_SEARCH}, 'gold') AND NOT coalesce(routine, false) AND strftime(filed, '%Y-%m-%d') LIKE '2025%' AND {_FAMILY.format(c='form')} = '10-K'")
def filter_search(spark, sf):
    return views.search(_log(spark, sf), signal="going_concern", sizes=["small", "mid"], term="Gold", routine=False, period="2025", form="10-K").select("seq")


@query("WITH n AS (SELECT cik, arg_min(company, struct_pack(a := -epoch(filed), b := company)) AS company, coalesce(arg_min(ticker, struct_pack(a := -epoch(filed), b := seq)) FILTER (ticker <> ''), '') AS ticker FROM disclosures WHERE cik IS NOT NULL AND filed IS NOT NULL GROUP BY 1) SELECT cik, company, ticker FROM n WHERE contains(lower(company), 'bra') OR lower(ticker) LIKE 'bra%' ORDER BY lower(company), cik LIMIT 8")
def company_suggestions(spark, sf):
    return views.company_search(views.directory(_log(spark, sf)), "bra").select("cik", "company", "ticker")


@query("WITH d AS (SELECT unnest(generate_series(DATE '2025-01-01', DATE '2025-06-30', INTERVAL 1 DAY))::DATE AS day) SELECT day, (SELECT count(*) FROM disclosures e WHERE e.filed = d.day AND signal_type = 'restatement') AS events FROM d WHERE isodow(day) < 6")
def chart_reaggregated(spark, sf):
    """Restatements on every weekday of half a year, empty days kept."""
    return views.day_axis(_log(spark, sf), "2025-01-01", "2025-06-30", F.col("signal_type") == "restatement")


@query("SELECT seq, concat_ws('; ', 'current=' || (CASE WHEN evidence.successor_named THEN 'Yes' WHEN NOT evidence.successor_named THEN 'No' END), 'topics=' || array_to_string(evidence.topics, ', ')) AS shown FROM disclosures".replace("'current='", "'successor_named='"))
def evidence_display(spark, sf):
    """Evidence as readers see it: tri-state booleans as yes or no, lists joined, unknowns left out."""
    return _log(spark, sf).select("seq", views.shown_evidence(F.col("evidence"), ["successor_named", "topics", "why"]).alias("shown"))


@query("SELECT seq, json_extract_string(to_json(evidence), '$.source') AS source, json_extract_string(to_json(evidence), '$.days_past_due_date')::INT AS days FROM disclosures")
def evidence_json(spark, sf):
    """Evidence to JSON and back."""
    e = _log(spark, sf)
    back = e.select("seq", F.from_json(F.to_json("evidence"), e.schema["evidence"].dataType).alias("b"))
    return back.select("seq", F.col("b.source").alias("source"), F.col("b.days_past_due_date").alias("days"))




@query(f"SELECT seq, trim({plain_sql('quote')}) AS plain FROM disclosures WHERE quote IS NOT NULL")
def quotes_without_figures(spark, sf):
    """Quotes with all that changes without meaning left out."""
    return _log(spark, sf).filter("quote is not null").select("seq", text.normalise_for_diff(F.col("quote")).alias("plain"))


@query("""
SELECT seq, len(q) - CASE WHEN contains(q, 'report') THEN instr(reverse(q), 'troper') + 5 ELSE len(q) + 1 END AS at FROM (SELECT seq, quote AS q FROM disclosures WHERE quote IS NOT NULL)
""")
def last_mention(spark, sf):
    """Where a word stands last in each quote, -1 where it does not."""
    return _log(spark, sf).filter("quote is not null").select("seq", text.last_match(F.col("quote"), "report").cast("long").alias("at"))


@query("SELECT seq, replace(quote, 'report', '      ') AS masked FROM disclosures WHERE quote IS NOT NULL")
def masked_quotes(spark, sf):
    """Matches blanked so that positions stay."""
    return _log(spark, sf).filter("quote is not null").select("seq", text.mask(F.col("quote"), "report").alias("masked"))


@query("""
WITH t AS (SELECT seq, trim(regexp_replace(quote, '[\\s\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{85}]+', ' ', 'g')) AS t FROM disclosures WHERE quote IS NOT NULL),
     h AS (SELECT *, left(t, 80) AS h, CASE WHEN contains(left(t, 80), ' ') THEN len(left(t, 80)) - instr(reverse(left(t, 80)), ' ') ELSE -1 END AS cut FROM t)
SELECT seq, CASE WHEN len(t) <= 80 THEN t ELSE regexp_replace(CASE WHEN cut > 48 THEN left(h, cut) ELSE h END, '[ ,;:\\-]+$', '') || '…' END AS short FROM h
""")
def short_quotes(spark, sf):
    """Quotes cut at a word before eighty characters."""
    return _log(spark, sf).filter("quote is not null").select("seq", text.truncate_words(F.col("quote"), 80).alias("short"))


@query("""
WITH t AS (SELECT seq, regexp_replace(translate(quote, chr(8203) || chr(8204) || chr(8205) || chr(65279) || chr(173), ''), '^[\\s\\x{a0}\\x{2000}-\\x{200a}\\x{202f}\\x{3000}]+|[\\s\\x{a0}\\x{2000}-\\x{200a}\\x{202f}\\x{3000}]+$', '', 'g') AS t FROM disclosures WHERE quote IS NOT NULL)
SELECT seq, CASE WHEN t = '' OR regexp_matches(t, '[.!?;:"”’)\\]…]$') THEN t ELSE regexp_replace(t, '[ ,;:–—-]+$', '') || '…' END AS closed FROM t
""")
def closed_quotes(spark, sf):
    return _log(spark, sf).filter("quote is not null").select("seq", text.close_quote(F.col("quote")).alias("closed"))


def _check_sql(name: str, worst: str, of: str, bad: str) -> str:
    return f"SELECT '{name}' AS \"check\", count(*) FILTER ({of}) AS rows, count(*) FILTER (({of}) AND ({bad})) AS bad, CASE WHEN count(*) FILTER (({of}) AND ({bad})) > 0 THEN '{worst}' ELSE 'ok' END AS status FROM disclosures"


_CONTRADICTS = r"""((signal_type = 'going_concern' AND (regexp_matches(quote, '(?i)\b(?:no|not)\b[^.;]{0,80}\b(?:substantial|grave)\s+doubt\b') OR regexp_matches(quote, '(?i)\bdoubt\b[^.;]{0,120}\b(?:is|was|has been)\s+not\s+raised\b')))
   OR (signal_type = 'material_weakness' AND regexp_matches(quote, '(?i)\bcontrols?\b[^.;]{0,120}\b(?:was|were|is|are)\s+effective\b') AND NOT regexp_matches(quote, '(?i)\bnot\s+effective\b|material\s+weakness')))"""
_CMP = "signal_type IN ('going_concern', 'policy_change', 'revenue_recognition')"
_CODED = "coalesce(confidence = 'confirmed' AND signal_type IN ('auditor_change', 'restatement', 'officer_departure'), false)"
_NAMED = "coalesce(trim(evidence.{0}) <> '', false)"
_CHECKS = " UNION ALL ".join(
    [
        _check_sql("links to its own filing", "fail", "true", "NOT coalesce(contains(replace(filing_url, '-', ''), replace(accession, '-', '')), false)"),
        _check_sql("states how it was found", "fail", "true", "NOT coalesce(" + " OR ".join(f"contains(lower(evidence.source), '{m}')" for m in quality.METHODS) + ", false)"),
        _check_sql("item code matches the signal", "fail", _CODED, "coalesce(evidence.item_code <> CASE signal_type WHEN 'auditor_change' THEN '4.01' WHEN 'restatement' THEN '4.02' ELSE '5.02' END, true)"),
        _check_sql("comparison names an earlier filing", "fail", _CMP, "coalesce(prior_accession, '') = ''"),
        _check_sql("comparison is of one form", "fail", _CMP + " AND coalesce(evidence.prior_form, '') <> ''", "regexp_replace(upper(trim(evidence.prior_form)), '/A$', '') <> regexp_replace(upper(trim(form)), '/A$', '')"),
        _check_sql("comparison looks back", "fail", _CMP + " AND coalesce(evidence.prior_filed, '') <> ''", "coalesce(TRY_CAST(evidence.prior_filed AS DATE) >= filed, false)"),
        _check_sql("quote opens with substance", "warn", "coalesce(trim(quote) <> '', false)", "regexp_matches(quote, '^[\\s,;:.)\\]]')"),
        _check_sql("quote ends cleanly", "warn", "coalesce(trim(quote) <> '', false)", "NOT regexp_matches(regexp_replace(quote, '[\\s\\x{a0}\\x{2000}-\\x{200a}\\x{202f}\\x{3000}]+$', ''), '[.!?;:\"”’)\\]…]$')"),
        _check_sql("quote contradicts its signal", "fail", "coalesce(trim(quote) <> '', false)", _CONTRADICTS),
        _check_sql("firm names hold letters", "fail", f"{_NAMED.format('predecessor_auditor')} OR {_NAMED.format('successor_auditor')}", " OR ".join(f"({_NAMED.format(f)} AND NOT regexp_matches(evidence.{f}, '\\p{{L}}'))" for f in ("predecessor_auditor", "successor_auditor"))),
    ]
)
_DUP = "SELECT 'no duplicates' AS \"check\", count(*) AS rows, count(*) - count(DISTINCT id) AS bad, CASE WHEN count(*) > count(DISTINCT id) THEN 'fail' ELSE 'ok' END AS status FROM disclosures"


@query(_CHECKS + " UNION ALL " + _DUP)
def quality_checks(spark, sf):
    e = _log(spark, sf)
    return quality.row_checks(e).unionByName(quality.duplicate_check(e))


@query(f"WITH c AS ({_CHECKS} UNION ALL {_DUP}) SELECT count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'warn') AS warn, count(*) FILTER (status = 'fail') AS fail, CASE WHEN bool_or(status = 'fail') THEN 'fail' WHEN bool_or(status = 'warn') THEN 'warn' ELSE 'ok' END AS overall FROM c")
def quality_summary(spark, sf):
    return quality.summarise(quality_checks(spark, sf))


@query("WITH h AS (SELECT *, substr(sha1(accession || ':' || signal_type), 1, 16) AS id FROM review_holds) SELECT id, accession, signal_type, scan_day, reason FROM h WHERE id NOT IN (SELECT id FROM disclosures WHERE id IS NOT NULL) AND id NOT IN (SELECT event_id FROM tombstones WHERE action = 'withdraw' AND event_id IS NOT NULL)")
def open_holds(spark, sf):
    """Held candidates that were neither published nor withdrawn since."""
    return quality.open_holds(table(spark, sf, "review_holds"), _log(spark, sf), table(spark, sf, "tombstones")).select("id", "accession", "signal_type", "scan_day", "reason")


@query("SELECT signal_type, count(*) AS held, count(*) FILTER (coalesce(trim(source_url), '') = '' OR coalesce(trim(reason), '') = '') AS incomplete FROM review_holds GROUP BY 1")
def hold_fields(spark, sf):
    h = table(spark, sf, "review_holds")
    blank = (F.coalesce(F.trim("source_url"), F.lit("")) == "") | (F.coalesce(F.trim("reason"), F.lit("")) == "")
    return h.groupBy("signal_type").agg(F.count(F.lit(1)).alias("held"), F.count_if(blank).alias("incomplete"))


@query("SELECT seq FROM disclosures WHERE " + _CONTRADICTS)
def contradictory_quotes(spark, sf):
    """Rows whose own quote says the opposite of their signal."""
    return _log(spark, sf).filter(quality.contradicts(F.col("signal_type"), F.col("quote"))).select("seq")


@query("SELECT DISTINCT id FROM disclosures WHERE id NOT IN (SELECT event_id FROM tombstones WHERE action = 'withdraw' AND event_id IS NOT NULL)")
def stream_dedupe(spark, sf):
    """The log as a stream from a landing folder builds it: every id once, however often and late it lands."""
    import uuid

    from tidemark.session import shared_dir
    from tidemark.streaming.log import keep_log

    e = _log(spark, sf).select("id", "seq", "signal_type", "filed")
    where = f"{shared_dir(spark)}/tidemark-stream-{uuid.uuid4().hex}"
    e.write.parquet(f"{where}/landing")
    keep_log(spark, f"{where}/landing", f"{where}/log", f"{where}/checkpoint", e.schema, table(spark, sf, "tombstones"))
    kept = spark.read.schema(e.schema).parquet(f"{where}/log") if exists(spark, f"{where}/log") else spark.createDataFrame([], e.schema)
    return kept.select("id")
