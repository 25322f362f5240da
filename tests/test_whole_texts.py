"""Queries over all texts, those outside ASCII included."""

import re

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.plans.registry import QUERIES
from tidemark.session import table

MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"


def plain(t):
    t = re.sub(r"\b\d[\d,.]*\b", " ", t.lower())
    t = re.sub(rf"\b({MONTHS})\b", " ", t)
    t = re.sub(r"\b(first|second|third|fourth)\s+quarter\b", " ", t)
    return " ".join(re.sub("[^a-z ]+", " ", t).split())


CASES = ["first\u00a0quarter of May", "the third\u2009 quarter", "Émay maié may\u0301 x", "\u201cMay\u201d \u2014 March\u2014April", "jüne june", "1\u202f234,5 \u20ac im august", "\u0663 march", "mayß _may_ may_", "İune first\u0085quarter", "\u00a0", ""]


def test_word_ends(spark):
    got = {r.t: r.p for r in spark.createDataFrame([(t,) for t in CASES], "t string").select("t", text.normalise_for_diff(F.col("t")).alias("p")).collect()}
    assert got == {t: plain(t) for t in CASES}


def test_all_quotes(spark, sf):
    want = {r.seq: plain(r.quote) for r in table(spark, sf, "disclosures").filter("quote is not null").select("seq", "quote").collect()}
    got = {r.seq: r.plain for r in QUERIES["quotes_without_figures"](spark, sf).collect()}
    assert got == want


def test_all_sentences(spark, sf):
    blanks = "[\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
    want = {r.doc_id: len([s for s in re.sub(blanks, " ", r.text).strip(" ").split(". ") if s]) for r in table(spark, sf, "documents").filter("text is not null").select("doc_id", "text").collect()}
    assert {r.doc_id: r.pieces for r in QUERIES["sentence_counts"](spark, sf).collect()} == want
