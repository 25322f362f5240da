import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.detect.periodic import changes
from tidemark.operators import followon, sequences, series, views

D0 = dt.date(2024, 1, 1)


def day(n):
    return D0 + dt.timedelta(n)


def test_prior_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([1, 2, None]), rng.choice("ab"), rng.choice([None, *map(day, range(12))]), "clash") for i in range(300)]
    got = {r.seq: (r.prior_day, r.prior_seq) for r in series.prior_in_series(spark.createDataFrame(rows, "seq int, cik int, form string, day date, prior string"), ["cik", "form"], "day", "seq", ["seq"]).collect()}
    for s, c, f, d, _ in rows:
        before = [(x[3], x[0]) for x in rows if None not in (c, d, x[3]) and (x[1], x[2]) == (c, f) and x[3] < d]
        assert got[s] == (max(before) if before else (None, None))
    assert len(got) == len(rows)


def test_follow_on_boundaries(spark):
    e = [("in", "a", 0), ("in", "b", 540), ("same", "a", 0), ("same", "b", 0), ("late", "a", 0), ("late", "b", 541), ("young", "a", 200), ("young", "b", 201), ("early", "b", 0), ("early", "a", 5), (None, "a", 0), ("future", "a", 900), ("in", "a", 30)]
    df = spark.createDataFrame([(c, k, day(n), "clash") for c, k, n in e], "cik string, kind string, day date, first string")
    r = followon.follow_on(df, "cik", "kind", "day", [("a", "b"), ("b", "z")], 540, F.lit(day(600))).orderBy("first").collect()
    assert (r[0].with_first, r[0].eligible, r[0].immature, r[0].followed, r[0].rate) == (5, 4, 1, 1, "25%")
    assert (r[1].with_first, r[1].followed) == (5, 0)


def test_follow_on_without_rows(spark):
    df = spark.createDataFrame([], "cik string, kind string, day date")
    assert followon.follow_on(df, "cik", "kind", "day", [("a", "b")], 5, F.lit(D0)).collect() == []


def seq_of(spark, *rows):
    df = spark.createDataFrame([(i, 1, s, f, day(n), a) for i, (s, f, n, a) in enumerate(rows)], "seq int, cik int, signal_type string, form string, filed date, accession string")
    return [(r.kind, r.days_since_previous, r.steps, r.span_days) for r in sequences.entity_sequences(df).orderBy("step").collect()]


def test_sequences(spark):
    assert seq_of(spark, ("late_filing", "NT 10-Q", 0, "a"), ("going_concern", "10-Q", 5, "b")) == []
    assert seq_of(spark, ("late_filing", "NT 10-K/A", 0, "a"), ("going_concern", "10-K", 18, "b")) == []
    assert seq_of(spark, ("late_filing", "NT 10-Q", 0, "a"), ("going_concern", "10-Q", 18, "b")) == [("late_filing", None, 2, 18), ("going_concern", 18, 2, 18)]
    assert seq_of(spark, ("late_filing", "NT 10-Q", 0, "a"), ("restatement", "8-K", 3, "b")) == [("late_filing", None, 2, 3), ("restatement", 3, 2, 3)]
    assert seq_of(spark, ("restatement", "8-K", 0, "a"), ("auditor_change", "8-K", 0, "a")) == []  # one filing is one occasion
    assert seq_of(spark, ("restatement", "8-K", 0, "a"), ("restatement", "8-K", 9, "b"), ("auditor_change", "8-K", 20, "c")) == [("restatement", None, 2, 20), ("auditor_change", 20, 2, 20)]


def test_run_before(spark):
    rows = [(i, 1, day(i * 365), s) for i, s in enumerate(["ok", "bad", "bad", "ok"])]
    r = series.run_before(spark.createDataFrame(rows, "seq int, cik int, day date, state string"), ["cik"], "day", "seq", F.col("state") == "bad").orderBy("seq").collect()
    assert [(x.run_len, x.run_start) for x in r] == [(0, None), (0, None), (1, day(365)), (2, day(365))]


def test_search_by_nothing_is_everything(spark):
    df = spark.createDataFrame([(1, "a")], "seq int, signal_type string")
    assert views.search(df).count() == 1


def test_periodic_changes(spark):
    filler = "Nothing else of note happened in this period. " * 60
    doubt = "Losses raise substantial doubt about our ability to continue as a going concern. "
    policy = "We recognize revenue when a performance obligation is met; contracts with customers state the transaction price under ASC 606. "
    note = lambda own: f"\n2. Revenue Recognition\n{policy * 3}{own}\n3. Debt\nNone.\n"
    old = "Pumps are delivered to customers at our plant in spring and revenue follows at that time. Hoses are sold by contract to farms and paid after the harvest of the year. " * 3
    new = "Software seats are licensed to customers by the month and revenue is spread evenly over each term. Support is promised to customers as a stand ready duty and earned as days go by. Upgrades granted to customers are held apart and priced on their own by our sales desk. " * 3
    docs = [
        (1, "10-K", day(0), "a", 1, filler + "Our internal control over financial reporting was effective."),
        (1, "10-K", day(365), "b", 2, filler + doubt + "Our internal control over financial reporting was not effective. We took up ASU 2024-03. The FASB issued ASU 2025-01, which we will adopt later."),
        (1, "10-K/A", day(400), "c", 3, filler),
        (1, "10-Q", day(380), "d", 4, filler + doubt),
        (2, "10-K", day(9), "e", 5, "short"),
        (2, None, None, "f", 6, None),
        (3, "10-K", day(0), "g", 7, filler),
        (3, "10-K", day(365), "h", 8, filler + "\nItem 1A. Risk Factors\n" + doubt + "\nItem 2. Properties\nNone. The FASB issued ASU 2024-03, which we will adopt later."),
        (4, "10-K", day(0), "i", 9, filler + note(old)),
        (4, "10-K", day(365), "j", 10, filler + note(new)),
        (4, "10-K", day(730), "k", 11, filler + note(new.replace("evenly", "equally"))),
    ]
    found = changes(spark.createDataFrame(docs, "cik long, form string, filed date, accession string, seq long, text string")).collect()
    got = {(r.accession, r.prior_accession, r.signal_type, r.prior_state, r.current_state if r.signal_type != "revenue_recognition" else None, r.direction) for r in found}
    assert got == {("b", "a", "going_concern", "none", "substantial_doubt", "escalated"), ("b", "a", "material_weakness", "effective", "material_weakness", "weakened"), ("b", "a", "policy_change", None, "2024-03", None), ("j", "i", "revenue_recognition", None, None, None)}
    by = {r.signal_type: r.evidence for r in found}
    assert by["policy_change"].new_standards == ["2024-03", "2025-01"] and by["policy_change"].adopted == ["2024-03"] and by["policy_change"].prior_form == "10-K"
    assert len(by["revenue_recognition"].new_language) >= 2 and by["revenue_recognition"].similarity < 0.6


def test_ranges_see_what_the_whole_series_sees(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 2, None]), rng.choice([None, *map(day, range(9))]), rng.choice(["bad", "ok", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "seq int, cik int, day date, state string")
    by = lambda out: sorted(map(str, out.collect()))
    whole, cut = (by(series.run_before(df, ["cik"], "day", "seq", F.col("state") == "bad", size=n)) for n in (10_000, 7))
    assert whole == cut and len(whole) == 400
    a, b = (series.previous(df.select("seq", "cik", "day"), ["cik"], "day", ["seq"], "seq", size=n).collect() for n in (10_000, 3))
    want = {}
    for c in (1, 2, None):
        own = sorted((r[2] or dt.date.min, r[0]) for r in rows if r[1] == c)
        want |= {x[1]: p for x, p in zip(own, [None, *[y[1] for y in own]], strict=False)}
    assert {r.seq: r.prior_seq for r in a} == {r.seq: r.prior_seq for r in b} == want
