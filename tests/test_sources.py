import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources import index, records

D = dt.date(2026, 8, 21)


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_form_index(spark):
    got = index.parse_form_index(
        lines(
            spark,
            "Form Type   Company Name        CIK         Date Filed  File Name",
            "-" * 80,
            "10-K        ACME & SONS INC     320193      20260821    edgar/data/320193/0000320193-26-000001.txt",
            "NT 10-Q     BETA  HOLDINGS      12          20260821    edgar/data/12/0000000012-26-000002.txt",
            "8-K         BAD DATE            12          20261399    edgar/data/12/0000000012-26-000003.txt",
            "no such line",
            "",
        )
    ).collect()
    assert [(r.form, r.company, r.cik, r.filed, r.accession) for r in got] == [("10-K", "ACME & SONS INC", 320193, D, "0000320193-26-000001"), ("NT 10-Q", "BETA  HOLDINGS", 12, D, "0000000012-26-000002")]


def test_master_index(spark):
    got = index.parse_master_index(lines(spark, "CIK|Company Name|Form Type|Date Filed|File Name", "12|BETA|8-K|2026-08-21|edgar/data/12/0000000012-26-000002.txt", "x|y")).collect()
    assert [(r.form, r.company, r.cik, r.filed) for r in got] == [("8-K", "BETA", 12, D)]


@pytest.mark.parametrize("n_form,n_master,source", [(0, 300, "master"), (150, 300, "master"), (250, 300, "form"), (3, 2, "form"), (2, 3, "master"), (2, 2, "form")])
def test_choice_of_source(spark, n_form, n_master, source):
    some = lambda n: spark.range(n).select(F.lit("2026-08-21").alias("day"), F.col("id").alias("seq"))
    assert {r.source for r in index.choose_source(some(n_form), some(n_master)).collect()} == {source}


def test_days_to_try_again(spark):
    files = spark.createDataFrame([("d1",), ("d2",), ("d2",)], "day string")
    rows = spark.createDataFrame([("d1", 1)], "day string, seq int")
    assert [r.day for r in index.unusable_days(files, rows).collect()] == ["d2"]


def test_header(spark):
    text = "<ACCESSION-NUMBER>1\n<PERIOD>20260630\n<ITEMS>4.01\n<ITEMS>9.01\n<ITEMS>4.01\n<FILER>\n<CONFORMED-NAME>ACME INC\n<ASSIGNED-SIC>2834\n<FORMER-COMPANY>\n<CONFORMED-NAME>OLD"
    df = spark.createDataFrame([("a", text), ("b", "nothing")], "accession string, header string")
    a, b = df.orderBy("accession").select(*records.header_fields(F.col("header"))).collect()
    assert (a["items"], a.sic, a.name, a.period) == (["4.01", "9.01"], 2834, "ACME INC", dt.date(2026, 6, 30))
    assert (b["items"], b.sic, b.name, b.period) == ([], None, "", None)


def test_unreadable_header_drops_the_filing(spark):
    f = spark.createDataFrame([("a", "", ["x"], 1, D), ("b", "B CO", ["x"], 1, D)], "accession string, company string, items array<string>, sic int, period date")
    h = spark.createDataFrame([("a", "<CONFORMED-NAME>ACME INC\n<ITEMS>5.02")], "accession string, header string")
    assert [(r.accession, r.company, r["items"]) for r in records.enrich(f, h).collect()] == [("a", "ACME INC", ["5.02"])]


def test_ragged_history_fails_whole(spark):
    blocks = spark.createDataFrame([(1, ["a", "b"], ["x", "y"]), (2, ["c"], ["z"]), (2, ["d", "e"], ["z"]), (3, ["f"], None)], "cik long, accessionNumber array<string>, form array<string>")
    got = records.submissions(blocks, ("accessionNumber", "form")).collect()
    assert sorted((r.cik, r.accessionNumber, r.form) for r in got) == [(1, "a", "x"), (1, "b", "y")]


def test_small_readers(spark):
    assert [r.frame for r in records.quarter_frames(spark, 12, "2026-09-14").orderBy("id").collect()][::11] == ["CY2026Q2I", "CY2023Q3I"]
    frames = spark.createDataFrame([(1, 5.0), (1, 9.0), (2, -1.0), (3, None)], "cik long, val double")
    assert [tuple(r) for r in records.frame_values(frames).collect()] == [(1, 9.0)]
    units = spark.createDataFrame([(1, {"USD": [{"val": 3.0}, {"val": 7.0}], "EUR": [{"val": 5.0}]})], "cik long, units map<string,array<struct<val:double>>>")
    assert [tuple(r) for r in records.concept_max(units).collect()] == [(1, 7.0)]
    assert spark.range(1).select(records.item_list(F.lit("4.01, 9.01,,")).alias("i")).first().i == ["4.01", "9.01"]


def test_damaged_log(spark, tmp_path):
    row = lambda i, seq: json.dumps({"id": i, "accession": "a", "seq": seq, "filed": "2026-01-02", "evidence": {"source": "note"}, "unknown": 1})
    (tmp_path / "2026-01-02.jsonl").write_text("\n".join([row("x", 1), "<<<<<<< ours", row("x", 2), "=======", row("y", 3), "{broken", ">>>>>>> theirs"]))
    (tmp_path / "2026-01-03.jsonl").write_text(row("x", 4) + "\n")
    stones = spark.createDataFrame([("y", "withdraw"), ("x", "odd"), (None, "withdraw")], "event_id string, action string")
    got = sorted((r.id, r.seq) for r in records.read_log(spark, str(tmp_path), stones).collect())
    assert got == [("x", 1), ("x", 4)]
    assert records.raw_rows(spark, str(tmp_path)).first().rows == 5
