import itertools

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import canonical, names, resolve
from tidemark.llm.queries import TIER_ALIASES

SAME = [
    ("Holtasvitz & Olkinness LLC", "Messrs. Holtasvitz and Olkinness"),
    ("Holtasvitz & Olkinness LLC", "OLKINNESS-HOLTASVITZ, L.L.C."),
    ("Holtasvitz & Olkinness LLC", "Holtassvitz Olkiness"),
    ("Gostastein Esklelhurst Nossantine LLP", "G. Esklelhurst Nossantine"),
    ("Gostastein Esklelhurst Nossantine LLP", "Gostasteinesklelhurstnossantine LLP"),
    ("Gostastein Esklelhurst Nossantine LLP", "Ｇostastein Esklelhurst\u00a0Nossantine (US) LLP"),
    ("William C. Varnumere, CPA", "Bill Varnumere"),
    ("William C. Varnumere, CPA", "Varnumere William, C.P.A."),
    ("Michael R. Dornidstein, CPA", "M.R. Dornidstein, Certified Public Accountant"),
    ("Sarah C. Ruskerland, C.P.A.", "S.C. Ruskerland, Certified Public Accountant"),
    ("Anthony K. Yarlindrick, CPA", "A.K. Yarlindrick, Certified Public Accountant"),
]
DIFFERENT = [
    ("Trevivcombe & Korbivby PLLC", "Wickamville & Trevivcombe PC"),
    ("Ilmakham & Lundodvane LLC", "Lundovridge & Ilmakham LLC"),
    ("Susan L. Lornining, CPA", "Susan L. Holtasridge, CPA"),
    ("Susan G. Jundasdine, CPA", "Susan K. Jundasdine, CPA"),
    ("Susan Jundasdine", "Katherine Jundasdine"),
    ("Esklelhurst & Nossantine LLP", "G. Esklelhurst Nossantine"),
]


@pytest.mark.parametrize("a,b", SAME)
def test_same(a, b):
    x, y = names.parts(a)[0], names.parts(b)[0]
    assert names.same_name(x, y) and names.same_name(y, x) and names.block_keys(x) & names.block_keys(y)


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_different(a, b):
    assert not names.same_name(names.parts(a)[0], names.parts(b)[0])


@given(st.text("abc", max_size=5), st.text("abc", max_size=5))
def test_one_edit_against_brute_force(a, b):
    def edits(s):
        yield s
        for i in range(len(s) + 1):
            for c in "abc":
                yield s[:i] + c + s[i:]
                yield s[:i] + c + s[i + 1 :]
            yield s[:i] + s[i + 1 :]
            if i + 2 <= len(s):
                yield s[:i] + s[i + 1] + s[i] + s[i + 2 :]

    assert names.one_edit(a, b) == (b in set(edits(a)))


def test_fillers():
    for f in ("n/a", "TBD", "-", "none", "not disclosed", "our former accountants", "see Exhibit 16.1", "Unknown", "\u200b", "prior auditor"):
        assert names.is_filler(f), f
    assert not names.is_filler("GEN") and not names.is_filler("Noneman & Partners LLP")


LIST = [canonical.Entry("A", ["Gostastein Esklelhurst Nossantine LLP"], ["GEN"]), canonical.Entry("B", ["Ilmakham & Lundodvane LLC"]), canonical.Entry("C", ["William C. Varnumere, CPA"])]


def test_mapping(spark):
    cases = {
        "G.E.N.": "A", "GEN (formerly Gostastein Esklelhurst)": "A", "gsotastein esklelhurst nossantine": "A", "Lundodvane & Ilmakham": "B", "Lundovridge & Ilmakham LLC": "unmatched",
        "Varnumere, Bill": "C", "n/a": "unmatched", " ": None, "": None, None: None, "\u200b": None, "x" * 50_000: "unmatched",
    }
    df = spark.createDataFrame([(v, "clash") for v in cases] * 2, "v string, ref_code string")
    got = {r.v: r.c for r in df.select("v", canonical.map_to_list("v", LIST).alias("c")).collect()}
    assert got == cases
    assert df.limit(0).select(canonical.map_to_list("v", LIST)).collect() == []


def test_tiers():
    tiers = [canonical.Entry("big_four", ["Big Four"], TIER_ALIASES["big_four"]), canonical.Entry("national", ["National"], TIER_ALIASES["national"]), canonical.Entry("other", ["Other"], TIER_ALIASES["other"])]
    m = canonical.Matcher(tiers, False, 1.0)
    want = {"big_four": "Big 4,BIG FOUR,Big IV,bigfour,big-four,Big Fur,the big four,Big Fuor", "national": "nat'l,natl.,Nation-wide (national),naational,NATIONAL,National tier", "other": "oth.,othr,all other,Other - local,ohter firm,other film", "unmatched": "n/a,pending,?,not known,tbd,unrated,see exhibit"}
    for code, values in want.items():
        for v in values.split(","):
            assert m.code(v) == code, v


def test_a_shared_alias_tells_neither():
    m = canonical.Matcher([canonical.Entry("A", ["Aldo Bremmer LLP"], ["abc"]), canonical.Entry("B", ["Cordo Dammer LLP"], ["ABC"])], True, 1.0)
    assert m.code("abc") == "unmatched" and m.code("Aldo Bremer") == "A"


def test_resolution(spark):
    groups = [
        ["Holtasvitz & Olkinness LLC", "Messrs. Holtasvitz and Olkinness", "Holtassvitz & Olkinness LLC", "Holtassvitz & Olkiness"],
        ["Lundovridge & Ilmakham LLC"],
        ["Ilmakham & Lundodvane LLC", "ilmakham lundodvane"],
        ["William C. Varnumere, CPA", "Bill Varnumere", "Varnumere, William C., CPA"],
        ["GEN", "GEN LLP", "GEN (formerly Gostastein Esklelhurst)", "Gostastein Esklelhurst Nossantine LLP", "G. Esklelhurst Nossantine"],
        ["Richard N. Stavundale, CPA", "R.N. Stavundale, Certified Public Accountant"],
        ["Richard S. Stavundale, CPA", "Dick S. Stavundale, CPA"],
        ["Richard Stavundale", "Dick Stavundale"],  # could be either
        ["Samuel T. Orbeck, CPA"],
        ["Susan T. Orbeck, CPA"],
        ["S. T. Orbeck CPA"],  # could be either
        ["Q.R.S.", "Quoralund Rhendimar Selkaby LLP"],
    ]
    fillers = [None, "", " ", "n/a", "N/A", "TBD", "-", "not disclosed"]
    df = spark.createDataFrame([(n, "clash") for n in [*itertools.chain(*groups), *fillers]] * 3, "name string, entity string")
    by = {}
    for r in resolve.resolve(df, "name").collect():
        by.setdefault(r.entity, set()).add(r.name)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, groups))
    pairs = {(r.name_a, r.name_b) for r in resolve.pairs(resolve.resolve(df, "name")).collect()}
    assert pairs == {p for g in groups for p in itertools.combinations(sorted(g), 2)}


def test_resolution_of_nothing(spark):
    assert resolve.resolve(spark.createDataFrame([], "name string"), "name").filter(F.lit(True)).collect() == []


def test_names_of_given_words_share_a_key():
    typed = ["Robert A. Thomas, CPA", "Bob Thomas", "Bob Tom", "Robert Thomaz", "R. Thomas", "Robert T.", "J. Francis", "John Francis", "Jack Francis", "Fohn Jrancis", "Ray Kim", "Raymond Kimberly", "Henry Lawrence", "Larry Henry", "Enry Lawrence", "Ehnry Alwrence"]
    typed += ["William Varnumere", "Eilliam Varnumere", "Eilliam Barnumere", "Iwlliam Avrnumere", "William Varnum K.", "William V. Kester", "Varnumere Bill"]
    words = ["robert", "bob", "thomas", "tom", "frank", "francis", "jack", "john", "ohn", "kim", "varnumere", "arnumere", "a", "t", "r"]
    tokens = {names.parts(n)[0] for n in typed} | set(itertools.permutations(words, 2)) | set(itertools.permutations(words[:6] + words[-3:], 3))
    keys = {t: names.block_keys(t) for t in tokens}
    accepted = [(a, b) for a, b in itertools.combinations(sorted(tokens), 2) if names.same_name(a, b)]
    assert len(accepted) > 1_000 and not [p for p in accepted if not keys[p[0]] & keys[p[1]]]


def test_resolution_of_given_words(spark):
    groups = [["Robert A. Thomas, CPA", "Bob Thomas"], ["J. Francis", "John Francis"], ["Eilliam Varnumere", "William Varnumere"]]
    df = spark.createDataFrame([(n,) for g in groups for n in g], "name string")
    assert {(r.name_a, r.name_b) for r in resolve.pairs(resolve.resolve(df, "name")).collect()} == {tuple(sorted(g)) for g in groups}


GIVEN_ONLY = [("William James", "Bill James"), ("Thomas Henry CPA", "Tom Henry CPA"), ("James William", "James Wiliam"), ("Robert Francis", "Bob Francis"), ("J. Francis", "John Francis"), ("Eilliam Varnumere", "William Varnumere")]


@pytest.mark.parametrize("a,b", GIVEN_ONLY)
def test_names_of_given_names_meet(a, b):
    x, y = names.parts(a)[0], names.parts(b)[0]
    assert names.same_name(x, y) and names.block_keys(x) & names.block_keys(y)


_WORD = st.sampled_from("james jim william bill will john jon j w a smith smyth smiht brown brwon lee".split())


@given(st.lists(_WORD, min_size=2, max_size=4), st.lists(_WORD, min_size=2, max_size=4))
def test_names_that_match_share_a_key_and_a_finer_one(a, b):
    a, b = tuple(a), tuple(b)
    if names.same_name(a, b) and a != b:
        shared = names.block_keys(a) & names.block_keys(b)
        assert shared
        fine = [(names.finer_keys(a, k), names.finer_keys(b, k)) for k in shared]
        assert any(not x or not y or x & y for x, y in fine)


def test_split_blocks_find_the_same(spark):
    typed = ["John Smith CPA", "Jon Smith", "J. Smith", "James Smith", "Jim Smith", "John A. Smith", "Smith John", "Jane Smith", "Grey & Stone LLP", "Stone Gray LLP", "Wm. Brown", "William Brown"]
    df = spark.createDataFrame([(t,) for t in typed], "n string")
    got = [{(r.name_a, r.name_b) for r in resolve.pairs(resolve.resolve(df, "n", crowded=c)).collect()} for c in (0, 10_000)]
    assert got[0] == got[1] and ("Jim Smith", "James Smith")[::-1] in got[0]


FIRMS = [canonical.Entry("D", ["Deloitte & Touche LLP"], ["Deloitte"]), canonical.Entry("G", ["Grant Thornton LLP"]), canonical.Entry("B", ["Baker Tilly US, LLP"]), canonical.Entry("M", ["Marsh & Alder LLP"], ["MA"])]


@pytest.mark.parametrize(
    "value,code",
    [
        ("engaged Grant Thornton as auditor", "G"), ("Grant Thornton, Chicago office", "G"), ("Deloitte until 2023", "D"), ("Deloitte, Denver", "D"), ("Deloitte & Touche LLP (Denver office)", "D"),
        ("Baker Tilly Hughes LLP", "unmatched"), ("Hughes Baker Tilly", "unmatched"), ("Deloitte, Haskins & Sells", "unmatched"), ("Deloitte, then Grant Thornton", "unmatched"), ("Deloitte / Thornton", "unmatched"), ("Smith, MA", "unmatched"), ("Grant Thorntn LLP", "G"), ("thornton", "unmatched"),
    ],
)
def test_a_name_within_a_longer_text(value, code):
    assert canonical.Matcher(FIRMS, strict=True, threshold=1.0).code(value) == code


def test_made_variants_are_found(spark):
    """Recall on variants made from names: of the list for the mapping, of invented names for the resolution."""
    import random

    rng = random.Random(11)
    parts = ["Trel", "Vorn", "Kast", "Mild", "Ospr", "Quen", "Harb", "Wex", "Yand", "Zol"]
    ends = ["ham", "vane", "ridge", "stone", "combe", "hurst", "wick", "mere"]
    firms = list({f"{rng.choice(parts)}{rng.choice(ends)} {rng.choice(parts).lower().title()}{rng.choice(ends)} LLP" for _ in range(40)})

    def vary(name):
        words = name.split()[:2]
        kind = rng.randrange(6)
        if kind == 0:
            i = rng.randrange(1, len(words[0]) - 1)
            words[0] = words[0][:i] + words[0][i + 1 :]
        elif kind == 1:
            i = rng.randrange(1, len(words[1]) - 2)
            words[1] = words[1][:i] + words[1][i + 1] + words[1][i] + words[1][i + 2 :]
        elif kind == 2:
            words.reverse()
        elif kind == 3:
            words = [w.upper() for w in words]
        elif kind == 4:
            words = ["".join(words)]
        return " ".join(words) + rng.choice(["", " LLP", ", L.L.P.", " CPAs"])

    made = [(vary(f), f) for f in firms for _ in range(6)]
    matcher = canonical.Matcher([canonical.Entry(f, [f]) for f in firms], strict=True, threshold=1.0)
    right = [matcher.code(v) == f for v, f in made]
    assert sum(right) >= 0.9 * len(made)
    entity = {r.name: r.entity for r in resolve.resolve(spark.createDataFrame([(n,) for n in {v for v, _ in made} | set(firms)], "n string"), "n").collect()}
    assert sum(entity[v] == entity[f] for v, f in made) >= 0.9 * len(made)
