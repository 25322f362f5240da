import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import truncation
from tidemark.session import table


@pytest.fixture(scope="module")
def rows(spark, sf):
    d = table(spark, sf.replace("sf0.001", "sf0.01"), "disclosures")
    return d.select("seq", F.stack(F.lit(2), F.lit("quote"), F.col("quote"), F.lit("why"), F.col("evidence.why")).alias("field", "value"), F.lit("clash").alias("cut"), F.lit(1.0).alias("score"))


@pytest.fixture(scope="module")
def model(rows):
    return truncation.train_on(rows, "field", "value")


def test_held_out_accuracy(model):
    precision, recall = model.held_out
    assert precision > 0.97 and recall > 0.97


@pytest.mark.parametrize(
    "text",
    ["The filer swapped its accounting firm.", "Does the amended report repeat it?", "The filer swapped its accounting firm.  \n", "The filer swapped its accounting firm.\u200b", "The filer swapped its accounting firm. [2]", "The filer swapped its accounting firm.¹", "Critical Accounting Estimates", "The departure “is not the result of any quarrel.”", "It was sold to Galdiquin Co.", "PART III — NARRATIVE"],
)
def test_whole(model, text):
    assert model.score(text) < 0


@pytest.mark.parametrize(
    "text",
    ["The filer swapped its accou", "The filer swapped its", "The filer swapped its acc…", "The filer swapped its ...", "The filer told the agency that a rep&am", "The conclusion on internal control chang [cont", "The filer swapped its )", "Plans to sell shares under Registration No.", "The departure “is not the res”"],
)
def test_cut(model, text):
    assert model.score(text) > 0


def test_random_cuts(model, rows):
    rng = random.Random(11)
    values = [r.value for r in rows.filter("field = 'why' and value rlike '[a-z][.]$'").select("value").distinct().collect()]
    cuts = [v[: rng.randrange(3, len(v) - 2)] for v in values for _ in range(5)]
    cuts = [c for c in cuts if not truncation._whole.search(c.strip())]
    assert sum(model.score(c) > 0 for c in cuts) > 0.97 * len(cuts)


def test_edges(spark, model):
    df = spark.createDataFrame([(1, "f", None), (2, "f", ""), (3, "f", "  "), (4, "f", "\u200b"), (5, "f", "word " * 20_000), (6, "f", "Done.")], "seq int, field string, value string")
    got = {r.seq: r.cut for r in truncation.find_cut(df, "field", "value", model).collect()}
    assert got == {1: False, 2: False, 3: False, 4: False, 5: True, 6: False}
    assert truncation.find_cut(df.limit(0), "field", "value").collect() == []


def test_limits_are_counted_on_different_values():
    lengths = {n: (10, 1) for n in range(80, 300)} | {200: (60, 55), 150: (60, 2), 255: (12, 12)}
    assert truncation.length_limits(lengths) == {200}


def test_every_field_trains_and_no_length_is_left_out(spark):
    rows = spark.createDataFrame([(f"f{k:03d}", f"This is the {w} whole sentence of field {k}.") for k in range(103) for w in ("first", "second")], "field string, value string")
    seen = {}
    kept = truncation.train
    try:
        truncation.train = lambda counts, lengths, **_: seen.update(counts=counts, lengths=lengths) or kept(counts, lengths)
        truncation.train_on(rows.filter("field in ('f000', 'f101', 'f102')"), "field", "value")
    finally:
        truncation.train = kept
    assert len(seen["counts"]) == 6 and sum(k for k, _ in seen["lengths"].values()) == 6
