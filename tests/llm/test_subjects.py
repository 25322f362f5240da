import numpy as np
import pytest

from tidemark.llm import queries, subjects


@pytest.fixture(scope="module")
def model(spark, sf):
    return queries._subject_model(spark, sf.replace("sf0.001", "sf0.1"))


def test_held_out_labels(model):
    """About one label in twenty is wrong, so no model can agree with more than nineteen in twenty."""
    precision, recall = model.held_out
    assert precision > 0.9 and recall > 0.9


def test_rule():
    codes = ["a", "b"]
    assert subjects.rule(codes, np.array([2, 0]), 12) == ["a"]
    assert subjects.rule(codes, np.array([2, 0]), 13) == ["general"]
    assert subjects.rule(codes, np.array([1, 1]), 2) == ["general"]
    assert subjects.rule(codes, np.array([2, 2]), 4) == ["a", "b"]


def test_sentences():
    text = "PART I\nItem 2.\n Costs of $1.5 million fell in May. See Note 3.\n\nNOTE 1 — BASIS\nPage 1 of 9\n* * *\nNothing else was owed."
    assert subjects.sentences(text) == ["costs of $0 million fell in m.", "nothing else was owed."]
    assert subjects.sentences(None) == [] and subjects.sentences("") == []


def test_edges(spark, model):
    bank = "Borrowers in 52 counties asked to defer payments, which weighs on the syndicated credit. "
    plain = "Figures are shown in thousands unless we say otherwise. "
    data = [(1, None), (2, ""), (3, " \n"), (4, "n"), (5, bank * 2 + plain), (6, bank + plain * 6), (7, bank * 2 + plain * 11), (8, (bank + plain) * 5_000)]
    df = spark.createDataFrame([(*d, "clash") for d in data], "doc_id int, text string, subject_code string")
    got = {}
    for r in subjects.assign(df, model).collect():
        got.setdefault(r.doc_id, []).append(r.subject_code)
    assert got == {4: ["general"], 5: ["banking"], 6: ["general"], 7: ["general"], 8: ["banking"]}
    assert subjects.assign(df.limit(0), model).collect() == []


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "k", "One thing is here.")], "doc_id int, key string, text string")
    labels = spark.createDataFrame([(9, "x"), (1, "odd"), (None, "x")], "doc_id int, subject_code string")
    sections = spark.createDataFrame([], "key string, section string")
    m = subjects.train(subjects.training_documents(docs, labels, sections, ["x", "y"]), ["x", "y"])
    assert [tuple(r) for r in subjects.assign(docs, m).collect()] == [(1, "general")]
