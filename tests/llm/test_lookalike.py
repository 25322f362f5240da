import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import lookalike as L

CASES = [
    ("Ａcme Corp", "acme corp", L.WIDE), ("eﬀect", "effect", L.JOINED), ("Ac\u200bme", "acme", L.INVISIBLE), ("soft\u00adhyphen", "softhyphen", L.INVISIBLE), ("Acme\u00a0Corp", "acme corp", L.BLANK), ("Acme\u3000Corp", "acme corp", L.BLANK),
    ("Compan\u0303i\u0301a", "compañía", L.ACCENT), ("Vеlosоro", "velosoro", L.MIXED), ("Resοurces", "resources", L.MIXED),
    ("“quoted” — and … so", "“quoted” — and ... so", 0), ("Velstat™", "velstattm", 0), ("6 m²", "6 m2", 0), ("Société", "société", 0), ("«Велдара» was", "«велдара» was", 0), ("β-agonists", "β-agonists", 0), ("line\nbreak", "line break", 0), ("Straße", "strasse", 0), ("[2] †", "[2] †", 0), ("", "", 0), ("  \n", "", 0),
]


@pytest.mark.parametrize("text,form,changes", CASES)
def test_cases(text, form, changes):
    assert L.consistent(text) == (form, changes)


@given(st.text(max_size=40))
def test_the_form_is_stable(text):
    once = L.consistent(text)[0]
    assert L.consistent(once)[0] == once or any(unicodedata.category(c) in ("Mn", "Cf") or ord(c) > 0x2FF for c in text)


def test_column(spark):
    df = spark.createDataFrame([(c[0], c[1], c[2], "clash") for c in CASES] * 2 + [(None, None, None, "x"), ("x " * 60_000, ("x " * 60_000).strip(), 0, "x"), ("é " * 60_000, ("é " * 60_000).strip(), 0, "x")], "t string, want string, flags int, form string")
    got = df.select("want", "flags", L.consistent_form("t").alias("c")).collect()
    assert all((r.c.form, r.c.changes) == (r.want, r.flags) if r.c else r.want is None for r in got)
    assert df.limit(0).select(L.consistent_form(F.col("t"))).collect() == []


def test_letters_of_many_scripts_become_equal():
    for typed, plain in (("Ꭺlpha", "alpha"), ("Ⲁlpha", "alpha"), ("ηew", "new"), ("ꓮlpha", "alpha"), ("ɡroup", "group"), ("Gгоup", "group"), ("ΑLPHA", "alpha"), ("Տtone", "stone")):
        assert L.consistent(typed)[0] == plain, typed
    for whole in ("Ελλάς", "Россия", "ᎠᏂᏴᏫᏯᎢ", "Yıldız"):
        assert L.consistent(whole) == (whole.casefold(), 0), whole
    assert L.consistent("ɡroup")[1] == 0 and L.consistent("ꓮlpha")[1] == L.MIXED
