"""Queries over the texts (documents, quotes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.detect import conclusions, items, spans
from tidemark.functions import scalars, text
from tidemark.operators import series
from tidemark.plans.registry import plain_sql, query
from tidemark.session import table


def _docs(spark, sf):
    return table(spark, sf, "documents")


@query("SELECT doc_id, n_chars FROM documents WHERE len(text) >= 2000")
def long_documents(spark, sf):
    """Texts long enough to compare."""
    return _docs(spark, sf).filter(F.length("text") >= 2000).select("doc_id", "n_chars")


@query(r"SELECT seq, array_to_string(list_sort(list_distinct(regexp_extract_all(quote, '(?i)(?:ASU|Update)\s*(?:No\.?\s*)?(20\d{2}-\d{2})', 1))), ',') AS codes FROM disclosures WHERE regexp_matches(quote, '(?i)(?:ASU|Update)\s*(?:No\.?\s*)?20\d{2}-\d{2}')")
def cited_standards(spark, sf):
    q = table(spark, sf, "disclosures").select("seq", conclusions.standards(F.col("quote")).alias("codes")).filter(F.size("codes") > 0)
    return q.select("seq", F.array_join(F.array_sort("codes"), ",").alias("codes"))


def _pairs(spark, sf, **carry):
    """Each text with its company's latest earlier text of the same base form. The series carries ids only; what is compared joins by id."""
    d = _docs(spark, sf).select("doc_id", "cik", scalars.base_form(F.col("base_form")).alias("base"), "filed")
    p = series.prior_in_series(d, ["cik", "base"], "filed", "doc_id", ["doc_id"]).filter("prior_doc_id is not null").select("doc_id", "prior_doc_id")
    own = _docs(spark, sf).filter("text is not null").select("doc_id", carry["own"].alias("own"))
    old = _docs(spark, sf).filter("text is not null").select(F.col("doc_id").alias("prior_doc_id"), carry["old"].alias("old"))
    return p.join(own, "doc_id").join(old, "prior_doc_id")


_PAIRS = """
WITH f AS (SELECT doc_id, cik, regexp_replace(upper(trim(base_form)), '/A$', '') AS base, filed, text FROM documents),
     d AS (SELECT cik, base, filed, max(doc_id) AS top FROM f WHERE filed IS NOT NULL GROUP BY ALL),
     p AS (SELECT cik, base, filed, lag(top) OVER (PARTITION BY cik, base ORDER BY filed) AS prior_doc_id FROM d),
     j AS (SELECT f.doc_id, p.prior_doc_id FROM f JOIN p ON p.cik = f.cik AND p.base = f.base AND p.filed = f.filed WHERE p.prior_doc_id IS NOT NULL)
"""


@query(_PAIRS + "SELECT doc_id, prior_doc_id FROM j")
def comparable_documents(spark, sf):
    d = _docs(spark, sf).select("doc_id", "cik", scalars.base_form(F.col("base_form")).alias("base"), "filed")
    return series.prior_in_series(d, ["cik", "base"], "filed", "doc_id", ["doc_id"]).filter("prior_doc_id is not null").select("doc_id", "prior_doc_id")


_SHINGLES = "list_distinct(list_transform(range(1, greatest(len({w}) - 4, 0) + 1), lambda i: array_to_string({w}[i:i + 4], ' ')))"


@query(_PAIRS + f"""
, t AS (SELECT doc_id, string_split(trim({plain_sql('text')}), ' ') AS w FROM documents WHERE text IS NOT NULL),
  s AS (SELECT doc_id, {_SHINGLES.format(w='w')} AS s FROM t),
  x AS (SELECT j.doc_id, j.prior_doc_id, len(a.s) AS na, len(b.s) AS nb, len(list_intersect(a.s, b.s)) AS common FROM j JOIN s a ON a.doc_id = j.doc_id JOIN s b ON b.doc_id = j.prior_doc_id)
SELECT doc_id, prior_doc_id, CASE WHEN na = 0 OR nb = 0 THEN 1.0::DOUBLE ELSE round(common / (na + nb - common), 4) END AS similarity FROM x
""")
def shingle_similarity(spark, sf):
    """How much of its wording each text shares with the comparable one before, figures and dates apart."""
    runs = text.shingle_hashes(text.normalise_for_diff(F.col("text")))
    p = _pairs(spark, sf, own=runs, old=runs)
    return p.select("doc_id", "prior_doc_id", F.round(text.jaccard(F.col("own"), F.col("old")), 4).alias("similarity"))


@query()
def novel_sentences(spark, sf):
    """Sentences of a text that share no run of words with the comparable text before."""
    p = _pairs(spark, sf, own=F.col("text"), old=text.shingle_hashes(text.normalise_for_diff(F.col("text"))))
    return p.select("doc_id", "prior_doc_id", F.explode(text.novel_sentences(F.col("own"), F.col("old"))).alias("sentence"))


@query()
def html_to_text(spark, sf):
    """Texts without markup, entities resolved, lines tidied."""
    return _docs(spark, sf).select("doc_id", text.html_to_text(F.col("text")).alias("plain"))


@query()
def document_states(spark, sf):
    """What the texts conclude on going concern and control, one look at each text, by form."""
    d = _docs(spark, sf).select("base_form", spans.document_concern(F.col("text")).alias("going_concern"), spans.document_control(F.col("text")).alias("control"))
    return d.groupBy("base_form", "going_concern", "control").agg(F.count(F.lit(1)).alias("documents"))


@query()
def document_topics(spark, sf):
    """Subjects of review that the texts touch, by the place of their first mention."""
    d = _docs(spark, sf).select("doc_id", items.topics(F.col("text")).alias("t")).filter(F.size("t") > 0)
    return d.select("doc_id", F.array_join("t", ",").alias("topics"))


@query(r"SELECT doc_id, len(list_filter(string_split_regex(trim(regexp_replace(text, '[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')), '\. '), lambda s: s <> ''))::INT AS pieces FROM documents WHERE text IS NOT NULL")
def sentence_counts(spark, sf):
    """The same of all texts, blanks of every kind apart."""
    d = _docs(spark, sf).filter("text is not null")
    return d.select("doc_id", F.size(F.filter(F.split(text.collapse(F.col("text")), r"\. "), lambda s: s != "")).alias("pieces"))


@query()
def periodic_changes(spark, sf):
    """State changes between each text and its comparable text before."""
    from tidemark.detect.periodic import changes

    d = _docs(spark, sf).filter("accession is not null and text is not null").select("cik", F.col("base_form").alias("form"), "filed", "accession", F.col("doc_id").alias("seq"), "text")
    return changes(d)


_FILLER = "Nothing else of note happened in this period. " * 60
_GRAVE = "Losses raise substantial doubt about our ability to continue as a going concern. "
#: (cik, form, filed, accession, what the report says beside its filler)
_STATED = (
    (1, "10-K", "2020-01-01", "a", "Our internal control over financial reporting was effective."),
    (1, "10-K", "2021-01-01", "b", _GRAVE + "Our internal control over financial reporting was not effective. We took up ASU 2024-03. The FASB issued ASU 2025-01, which we will adopt later."),
    (1, "10-K/A", "2021-03-01", "c", ""),
    (1, "10-Q", "2021-02-01", "d", _GRAVE),
    (2, "10-K", "2020-01-01", "e", ""),
    (2, "10-K", "2021-01-01", "f", "\nItem 1A. Risk Factors\n" + _GRAVE + "\nItem 2. Properties\nNone. The FASB issued ASU 2024-03, which we will adopt later."),
    (3, "10-Q", "2020-05-01", "g", "Our plans alleviate the substantial doubt about our ability to continue as a going concern."),
    (3, "10-Q", "2020-08-01", "h", _GRAVE),
    (3, "10-Q", "2020-11-01", "i", "No conditions or events raise substantial doubt about our ability to continue as a going concern."),
)


@query("""
SELECT * FROM (VALUES ('b', 'a', 'going_concern', 'none', 'substantial_doubt', 'escalated'), ('b', 'a', 'material_weakness', 'effective', 'material_weakness', 'weakened'), ('b', 'a', 'policy_change', NULL, '2024-03', NULL),
  ('h', 'g', 'going_concern', 'doubt_alleviated', 'substantial_doubt', 'escalated'), ('i', 'h', 'going_concern', 'substantial_doubt', 'none', 'eased')) v(accession, prior_accession, signal_type, prior_state, current_state, direction)
""")
def periodic_changes_stated(spark, sf):
    """State changes between reports that are written here: adopted standards only, risk factors and amendments give none."""
    from tidemark.detect.periodic import changes

    docs = spark.createDataFrame([(c, f, d, a, i, _FILLER + t) for i, (c, f, d, a, t) in enumerate(_STATED)], "cik long, form string, filed string, accession string, seq long, text string")
    found = changes(docs.withColumn("filed", F.col("filed").cast("date")))
    return found.select("accession", "prior_accession", "signal_type", "prior_state", "current_state", "direction")
