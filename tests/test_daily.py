import datetime as dt

from tidemark.plans import daily

D = dt.date(2026, 8, 21)
LONG = "Nothing else of note happened in this period. " * 60


def test_a_day(spark):
    rows = [
        (1, "8-K", "Acme", 1, "a1", "4.01", 2834, "The Board dismissed Deloitte & Touche LLP, its accounting firm, and engaged Alder & Birch LLP. There were no disagreements."),
        (2, "8-K", "Acme", 1, "a1", "4.01", 2834, None),  # listed twice
        (3, "8-K/A", "Acme", 1, "a2", "4.01", 2834, "This amendment is filed solely to add Exhibit 16.1."),
        (4, "8-K", "Beta", 2, "b1", "5.02", None, "A director resigned. The Chief Financial Officer signs."),
        (5, "8-K", "Fund", 3, "c1", "4.02", 6726, "Shut out by its industry."),
        (6, "NT 10-Q", "Gamma", 4, "d1", "", 100, "period ended: June 30, 2026 PART III The company could not close its ledgers before the day on which its report was due. PART IV"),
        (7, "NT 10-K", "Gamma", 4, "d2", "", 100, "PART III We found errors in our prior accounts and an internal review of these goes on now. PART IV"),
        (8, "UPLOAD", "Delta", 5, "e1", "", 100, "Re: Form 10-K\nDear Sir:\nWe have reviewed your filing. Please tell us how segments are judged in your notes. " + "We look at the notes with care. " * 12),
        (9, "10-K", "Echo", 6, "f1", "", 100, LONG + "Losses raise substantial doubt about our ability to continue as a going concern."),
        (10, "N-PX", "Zeta", 7, "g1", "", 100, "no candidate"),
        (11, "8-K", "Eta", 8, "h1", "4.02", 100, None),
        (12, "8-K", "Lost", 9, "i1", "4.02", None, "its header can't be read"),
    ]
    filings = spark.createDataFrame([(s, f, c, k, D, a, D) for s, f, c, k, a, *_ in rows], "seq long, form string, company string, cik long, filed date, accession string, scan_day date")
    headers = spark.createDataFrame([(a, f"<ITEMS>{i}\n" * bool(i) + f"<ASSIGNED-SIC>{s}\n" * (s is not None)) for q, _, _, _, a, i, s, _ in rows if q not in (2, 12)], "accession string, header string")
    docs = spark.createDataFrame([(a, t) for *_, a, _, _, t in rows if t], "accession string, text string")
    history = spark.createDataFrame([(6, "10-K", dt.date(2025, 8, 20), "f0", 0, LONG)], "cik long, form string, filed date, accession string, seq long, text string")
    floats = spark.createDataFrame([(1, 8e8)], "cik long, public_float double")
    log = spark.createDataFrame([], "id string")
    stones = spark.createDataFrame([], "event_id string, action string")
    good, held = daily.scan(daily.Inputs(filings, headers, docs, history, floats), log, stones)
    got = {(r.accession, r.signal_type, r.severity, r.size_tier) for r in good.collect()}
    assert got == {("a1", "auditor_change", "high", "large"), ("d2", "late_filing", "high", ""), ("e1", "comment_letter", "normal", ""), ("f1", "going_concern", "high", ""), ("h1", "restatement", "high", "")}
    assert held.collect() == []
    by = {r.accession: r for r in good.collect()}
    a1 = by["a1"]
    assert (a1.evidence.direction, a1.evidence.predecessor_auditor, a1.evidence.successor_auditor, a1.evidence.tier_downgrade, a1.evidence.disagreements_disclosed) == ("dismissed", "Deloitte & Touche LLP", "Alder & Birch LLP", True, False)
    assert a1.headline == "Acme dismissed Deloitte & Touche LLP for Alder & Birch LLP"
    assert (by["d2"].evidence.filings_in_batch, by["d2"].evidence.other_forms) == (2, "NT 10-Q") and "2 periodic reports" in by["d2"].headline
    assert by["f1"].evidence.prior_state == "none" and by["f1"].headline == "Echo now reports substantial doubt" and by["f1"].quote.startswith("Losses raise")
    assert by["e1"].evidence.topics == []
    again, _ = daily.scan(daily.Inputs(filings, headers, docs, history, floats), good, stones)
    assert again.collect() == []


def test_scanned_from_the_command_line(spark, tmp_path):
    from tidemark.plans.daily import scan_days

    at = lambda n: str(tmp_path / f"{n}.parquet")
    day = lambda k: dt.date(2026, 8, 20 + k)
    filings = [(k, "8-K", "Acme", 1, day(k), f"a{k}", day(k)) for k in (0, 1)] + [(9, "8-K", "Acme", 1, day(1), "a0", day(1))]
    spark.createDataFrame(filings, "seq long, form string, company string, cik long, filed date, accession string, scan_day date").write.parquet(at("filings"))
    spark.createDataFrame([(f"a{k}", "<ITEMS>4.02\n") for k in (0, 1)], "accession string, header string").write.parquet(at("headers"))
    spark.createDataFrame([("a0", "The board concluded so.")], "accession string, text string").write.parquet(at("documents"))
    spark.createDataFrame([], "cik long, form string, filed date, accession string, seq long, text string").write.parquet(at("history"))
    spark.createDataFrame([], "cik long, public_float double").write.parquet(at("floats"))
    spark.createDataFrame([], "event_id string, action string").write.parquet(at("tombstones"))
    log = str(tmp_path / "log")
    assert [(str(d), n, h) for d, n, h in scan_days(spark, str(tmp_path), log, days=2)] == [("2026-08-20", 1, 0), ("2026-08-21", 1, 0)]
    assert [(n, h) for _, n, h in scan_days(spark, str(tmp_path), log, date="2026-08-21")] == [(0, 0)]
    assert {(r.accession, r.signal_type, r.evidence.limb) for r in spark.read.parquet(log).collect()} == {("a0", "restatement", "a"), ("a1", "restatement", None)}
