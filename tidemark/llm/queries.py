"""The pN_ queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import batches, canonical, lookalike, packing, patterns, resolve, subjects, tokens, truncation
from tidemark.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# 1


def _histories(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "disclosures").select("id", "seq", "cik", "signal_type", "filed").dropna(subset=["cik", "signal_type", "filed"])
    return patterns.first_by_id(rows, "id", "seq")


@query
def p1_found(spark, sf):
    found = patterns.frequent_patterns(_histories(spark, sf), "cik", "signal_type", "filed")
    return found.select(F.array_join("pattern", ">").alias("pattern"))


@query
def p1_support(spark, sf):
    """The patterns with the number of companies that show each, and of all companies."""
    found = patterns.frequent_patterns(_histories(spark, sf), "cik", "signal_type", "filed")
    return found.select(F.array_join("pattern", ">").alias("pattern"), "entities", "of_entities")


_P1 = """
WITH kept AS (SELECT arg_min(cik, seq) AS cik, arg_min(signal_type, seq) AS signal_type, arg_min(filed, seq) AS filed
              FROM disclosures WHERE cik IS NOT NULL AND signal_type IS NOT NULL AND filed IS NOT NULL GROUP BY id),
     e AS (SELECT DISTINCT cik, signal_type, filed FROM kept),
     n AS (SELECT count(DISTINCT cik) AS n FROM e),
     s1 AS (SELECT cik, signal_type AS pattern, min(filed) AS d FROM e GROUP BY 1, 2),
     s2 AS (SELECT s.cik, s.pattern || '>' || e.signal_type AS pattern, min(e.filed) AS d FROM s1 s JOIN e ON e.cik = s.cik AND e.filed > s.d GROUP BY 1, 2),
     s3 AS (SELECT s.cik, s.pattern || '>' || e.signal_type AS pattern, min(e.filed) AS d FROM s2 s JOIN e ON e.cik = s.cik AND e.filed > s.d GROUP BY 1, 2),
     s4 AS (SELECT s.cik, s.pattern || '>' || e.signal_type AS pattern, min(e.filed) AS d FROM s3 s JOIN e ON e.cik = s.cik AND e.filed > s.d GROUP BY 1, 2),
     c AS (SELECT pattern, count(*) AS entities FROM (FROM s2 UNION ALL FROM s3 UNION ALL FROM s4) GROUP BY 1)
"""
ORACLE["p1_found"] = _P1 + "SELECT pattern FROM c, n WHERE 100 * entities >= 3 * n.n"
ORACLE["p1_support"] = _P1 + "SELECT pattern, entities, n.n AS of_entities FROM c, n WHERE 100 * entities >= 3 * n.n"


# 2


def _two_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "disclosures").select("seq", "company", "quote")
    return rows.select("seq", F.stack(F.lit(2), F.lit("company"), F.col("company"), F.lit("quote"), F.col("quote")).alias("field", "value"))


@query
def p2_found(spark, sf):
    rows = _two_fields(spark, sf).filter(lookalike.needs_work(F.col("value")))
    return rows.filter(lookalike.consistent_form("value").getField("changes") > 0).select("seq", "field")


@query
def p2_forms(spark, sf):
    """The consistent form of every company name and quote."""
    rows = _two_fields(spark, sf).filter("value is not null")
    return rows.select("seq", "field", lookalike.consistent_form("value").getField("form").alias("form"))


@query
def p2_company_spellings(spark, sf):
    """Company names in one consistent form, with the rows and the different spellings behind it."""
    rows = table(spark, sf, "disclosures").filter("company is not null").select("company", lookalike.consistent_form("company").getField("form").alias("form"))
    return rows.groupBy("form", "company").count().groupBy("form").agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("spellings"))


ORACLE["p2_found"] = r"""
WITH v AS (SELECT seq, 'company' AS field, company AS value FROM disclosures UNION ALL SELECT seq, 'quote', quote FROM disclosures),
     z AS (SELECT seq, field, value, regexp_replace(value, '[\x{ad}\x{34f}\x{61c}\x{115f}\x{1160}\x{17b4}\x{17b5}\x{180b}-\x{180f}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{3164}\x{fe00}-\x{fe0f}\x{feff}\x{ffa0}\x{fff0}-\x{fff8}]', '', 'g') AS clean FROM v)
SELECT seq, field FROM z
WHERE value <> clean
   OR regexp_matches(clean, '[\t\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]')
   OR regexp_matches(clean, '[\x{ff01}-\x{ff5e}\x{ffe0}-\x{ffe6}\x{fb00}-\x{fb06}\x{132}\x{133}]')
   OR regexp_matches(clean, '\p{L}[\x{300}-\x{36f}]')
   OR regexp_matches(clean, '\p{Latin}[\p{L}\p{M}\p{N}_]*[\p{Greek}\p{Cyrillic}\p{Armenian}]|[\p{Greek}\p{Cyrillic}\p{Armenian}][\p{L}\p{M}\p{N}_]*\p{Latin}')
"""


# 3


def _cut(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "disclosures").select("seq", F.col("evidence.source").alias("source"), "quote", F.col("evidence.why").alias("why"))
    long = rows.select("seq", "source", F.stack(F.lit(2), F.lit("quote"), F.col("quote"), F.lit("why"), F.col("why")).alias("field", "value")).filter("trim(value) <> ''")
    return truncation.find_cut(long, "field", "value")


@query
def p3_found(spark, sf):
    return _cut(spark, sf).filter("cut").select("seq", "field")


@query
def p3_rates(spark, sf):
    """How often each source cuts each field."""
    by = _cut(spark, sf).groupBy("source", "field").agg(F.count(F.lit(1)).alias("filled"), F.count_if("cut").alias("cut"))
    return by.withColumn("share", F.round(F.col("cut") / F.col("filled"), 6))


# 4

#: Other ways to write the three tiers.
TIER_ALIASES = {"big_four": ["big 4", "big4", "b4", "big iv", "bigfour", "big_four"], "national": ["natl", "nat l", "nationwide", "nation wide"], "other": ["oth", "othr", "local"]}


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "disclosures").select("seq", "evidence.predecessor_auditor", "evidence.predecessor_tier", "evidence.successor_tier")
    firms = canonical.read_list(table(spark, sf, "audit_firms"), "firm_code", "firm_name", "short_name")
    tiers = canonical.read_list(table(spark, sf, "firm_tiers"), "tier_code", "tier_name", extra=TIER_ALIASES)
    to_tier = lambda c: canonical.map_to_list(c, tiers, strict=False, threshold=1.0)
    used = e.filter("predecessor_auditor is not null or predecessor_tier is not null or successor_tier is not null")
    coded = used.select("seq", canonical.map_to_list("predecessor_auditor", firms).alias("a"), to_tier("predecessor_tier").alias("b"), to_tier("successor_tier").alias("c"))
    return coded.select("seq", F.stack(F.lit(3), F.lit("predecessor_auditor"), "a", F.lit("predecessor_tier"), "b", F.lit("successor_tier"), "c").alias("field", "ref_code"))


@query
def p4_found(spark, sf):
    return _typed(spark, sf).filter("ref_code is not null")


@query
def p4_unmatched(spark, sf):
    """How many values of each field fit nothing on the lists."""
    return _typed(spark, sf).filter("ref_code is not null").groupBy("field").agg(F.count(F.lit(1)).alias("typed"), F.count_if(F.col("ref_code") == canonical.UNMATCHED).alias("unmatched"))


# 5


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "disclosures").select("evidence.predecessor_auditor", "evidence.successor_auditor")
    typed = e.select(F.stack(F.lit(2), F.col("predecessor_auditor"), F.col("successor_auditor")).alias("name"))
    known = table(spark, sf, "audit_firms").select(F.col("firm_name").alias("name"), F.col("short_name").alias("alias"))
    return resolve.resolve(typed, "name", known)


@query
def p5_found(spark, sf):
    return resolve.pairs(_resolved(spark, sf))


@query
def p5_entities(spark, sf):
    """Every spelling with the entity it names."""
    return _resolved(spark, sf)


# 6


@query
def p6_found(spark, sf):
    return batches.fold(table(spark, sf, "disclosures"), "scan_day")


_P6_PARTS = r"(?:^|[^0-9])([0-9]{1,10})[^0-9A-Za-z]{1,3}([0-9]{1,2})[^0-9A-Za-z]{1,3}([0-9]{1,6})(?:[^0-9]|$)"
ORACLE["p6_found"] = f"""
WITH RECURSIVE t AS (SELECT seq, signal_type AS s, upper(trim(accession)) AS a,
                            regexp_replace(regexp_replace(lower(id), '^\\s*[a-z0-9]+:', ''), '[^0-9a-f]', '', 'g') AS i,
                            cik::VARCHAR || '|' || upper(trim(form)) || '|' || filed::VARCHAR AS g
                     FROM disclosures),
     m AS (SELECT seq, s, i, g, CASE WHEN regexp_matches(a, '{_P6_PARTS}')
                  THEN lpad(regexp_extract(a, '{_P6_PARTS}', 1), 10, '0') || lpad(regexp_extract(a, '{_P6_PARTS}', 2), 2, '0') || lpad(regexp_extract(a, '{_P6_PARTS}', 3), 6, '0')
                  ELSE lpad(regexp_replace(a, '[^0-9]', '', 'g'), 18, '0') END AS n FROM t),
     e AS (SELECT a.seq AS a, b.seq AS b FROM m a JOIN m b ON a.s = b.s AND a.n = b.n AND a.seq <> b.seq
           UNION SELECT a.seq, b.seq FROM m a JOIN m b ON a.s = b.s AND a.i = b.i AND a.seq <> b.seq
           UNION SELECT a.seq, b.seq FROM m a JOIN m b ON a.s = b.s AND a.g = b.g AND a.seq <> b.seq WHERE damerau_levenshtein(a.n, b.n) = 1),
     r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT min(b) AS kept_seq, a AS dup_seq FROM r GROUP BY a HAVING min(b) < a
"""


# 7


@query
def p7_ids(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", tokens.token_ids(spark, "text").alias("ids"))


# 8


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", tokens.token_count(spark, "text").alias("n_tokens"))


@query
def p8_containers(spark, sf):
    """Container and position of each document or piece."""
    placed = packing.pack(_sizes(spark, sf), "doc_id", "n_tokens")
    return placed.select(F.col("item").alias("doc_id"), "piece", F.col("size").alias("n_tokens"), "container", "position")


@query
def p8_fill(spark, sf):
    """How well the containers are filled, and how many of them are certified to be as few as possible."""
    placed = packing.pack(_sizes(spark, sf), "doc_id", "n_tokens")
    boxes = placed.groupBy("container").agg(F.sum("size").alias("used"), F.first("certified").alias("certified"))
    return boxes.agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.round(F.sum("used") / (F.count(F.lit(1)) * packing.CAPACITY), 6).alias("fill"), F.count_if("certified").alias("certified"))


# 9


def _subject_model(spark: SparkSession, sf: str) -> subjects.Model:
    docs = table(spark, sf, "documents").select("doc_id", F.col("accession").alias("key"), "text")
    sections = table(spark, sf, "filings").select(F.col("accession").alias("key"), F.col("sic_desc").alias("section"))
    codes = [r[0] for r in table(spark, sf, "subject_areas").select("subject_code").collect()]
    return subjects.train(subjects.training_documents(docs, table(spark, sf, "doc_labels"), sections, codes), codes)


@query
def p9_found(spark, sf):
    return subjects.assign(table(spark, sf, "documents"), _subject_model(spark, sf))


@query
def p9_mix(spark, sf):
    """The mix of the corpus by subject: documents and characters of each; a document of several subjects counts for each."""
    docs = table(spark, sf, "documents")
    shared = spark.sparkContext.broadcast(_subject_model(spark, sf))
    coded = docs.select("n_chars", F.explode(subjects.subjects_of("text", shared)).alias("subject_code"))
    return coded.groupBy("subject_code").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars"))
