import base64

import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.session import table

RANKS = tokens.parse_ranks(open(tokens.VOCABULARY, "rb").read())
PUBLIC = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OURS = tokens.Encoder(RANKS)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=["Cs"]), max_size=200))
def test_same_ids_as_the_public_library(text):
    assert OURS.encode(text) == PUBLIC.encode_ordinary(text)


def test_merges_without_the_whole_piece_shortcut():
    for word in (b"international", b"aaaaaaaaaaa", b"Zeldasdorf", bytes(range(256))):
        assert tokens.merge(b" " + word + b"qzx", RANKS) == PUBLIC._encode_single_piece(b" " + word + b"qzx")


def test_very_long_piece_and_special_string():
    for text in ("ab" * 20_000, "é" * 5_000, "<|endoftext|> x", " " * 3_000 + "a\n\n  b"):
        assert OURS.encode(text) == PUBLIC.encode_ordinary(text)


def test_table(spark, sf):
    docs = table(spark, sf, "documents").withColumn("ids", F.lit("clash"))
    rows = docs.select("doc_id", "text", tokens.token_ids(spark, "text").alias("got"), tokens.token_count(spark, "text").alias("n")).collect()
    assert rows and all(r.got == PUBLIC.encode_ordinary(r.text or "") and r.n == len(r.got) for r in rows)
    assert any(r.text is None and r.got == [] for r in rows) or docs.filter("text is null").count() == 0


def test_null_empty_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a")], "doc_id bigint, text string")
    got = {r.doc_id: r.ids for r in df.select("doc_id", tokens.token_ids(spark, "text").alias("ids")).collect()}
    assert got == {1: [], 2: [], 3: [64]}
    assert df.limit(0).select(tokens.token_ids(spark, "text")).collect() == []


def test_rank_file_is_base64():
    line = open(tokens.VOCABULARY, "rb").readline().split()
    assert base64.b64decode(line[0])
