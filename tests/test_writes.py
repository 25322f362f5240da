import datetime as dt
import json

import pytest

from tidemark import quality, sinks
from tidemark.plans import hooks
from tidemark.plans.schedule import State
from tidemark.session import table
from tidemark.streaming.log import first_seen, keep_log

D = dt.date(2026, 8, 21)
SCHEMA = "seq long, id string, signal_type string, scan_day date"


def events(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "log")
    stones = spark.createDataFrame([("w", "withdraw")], "event_id string, action string")
    batch = events(spark, (1, "a", "x", D), (2, "a", "x", D), (3, "w", "x", D), (4, None, "x", D))
    assert sinks.append_events(batch, path, stones) == 1
    assert sinks.append_events(batch, path, stones) == 0
    later = events(spark, (5, "a", "x", D + dt.timedelta(1)), (6, "b", "x", D + dt.timedelta(1)))
    assert sinks.append_events(later, path, stones) == 1
    assert sorted((r.id, r.seq) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 6)]


def test_repair(spark, tmp_path):
    path = str(tmp_path / "log")
    events(spark, (1, "a", "x", D), (2, "a", "x", D), (3, "b", "x", dt.date(2026, 8, 22))).write.partitionBy("scan_day").parquet(path)
    assert sinks.repair(spark, path) == 1 and sinks.repair(spark, path) == 0
    assert sorted((r.id, r.seq) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]


def test_years_are_disjoint_and_complete(spark, sf, tmp_path):
    e = table(spark, sf, "disclosures").select("seq", "filed")
    counts = {r.year: r.events for r in sinks.export_years(e, str(tmp_path / "y")).collect()}
    back = spark.read.json(str(tmp_path / "y")).groupBy("year").count().collect()
    assert {r.year: r["count"] for r in back} == counts and sum(counts.values()) == e.filter("filed is not null").count()


def test_empty_never_replaces_filled(spark, tmp_path):
    path = str(tmp_path / "r")
    assert sinks.save_guarded(events(spark, (1, "a", "x", D)), path)
    assert not sinks.save_guarded(events(spark), path)
    assert spark.read.parquet(path).count() == 1


def test_control_files(tmp_path):
    p = str(tmp_path / "s" / "state.json")
    sinks.save_json({"b": 1, "a": "é"}, p)
    assert sinks.load_json(p, None) == {"a": "é", "b": 1}
    (tmp_path / "bad.json").write_text("{")
    assert sinks.load_json(str(tmp_path / "bad.json"), {}) == {} and json.load(open(p, encoding="utf-8"))
    state = {}
    for i in range(70):
        state = sinks.record_run(state, {"date": "2026-08-21", "index_rows": 100 - i, "candidates": 5})
    state = sinks.record_run(state, {"date": "2026-08-22", "index_rows": 9, "candidates": 5, "blocked": True})
    assert len(state["runs"]) == 60 and state["scan_days"] == {"2026-08-21": {"index_rows": 100, "candidates": 5}}


def test_feed(spark, sf):
    xml = sinks.feed_xml(sinks.feed_items(table(spark, sf, "disclosures"), 5), "A & B", "https://x.example/")
    assert xml.count("<item>") == 5 and "A &amp; B" in xml


def test_stream_keeps_the_log(spark, tmp_path):
    landing, log, check = (str(tmp_path / n) for n in ("in", "log", "check"))
    first = events(spark, (1, "a", "x", D), (2, "b", "x", D))
    first.write.mode("append").parquet(landing)
    assert keep_log(spark, landing, log, check, first.schema) == 1
    assert keep_log(spark, landing, log, check, first.schema) == 0  # nothing new has landed
    events(spark, (3, "a", "x", D), (4, "c", "x", dt.date(2020, 1, 1))).write.mode("append").parquet(landing)
    assert keep_log(spark, landing, log, check, first.schema) == 1  # late rows count
    assert sorted((r.id, r.seq) for r in spark.read.parquet(log).collect()) == [("a", 1), ("b", 2), ("c", 4)]


def test_stream_fails_closed(spark, tmp_path):
    landing, log, check = (str(tmp_path / n) for n in ("in", "log", "check"))
    first = events(spark, (1, "a", "x", D))
    first.write.parquet(landing)
    bad = lambda df: spark.createDataFrame([("broken", "fail")], "check string, status string")
    with pytest.raises(Exception, match="broken"):
        keep_log(spark, landing, log, check, first.schema, checks=bad)
    assert keep_log(spark, landing, log, check, first.schema) == 1  # the same files are met again
    assert spark.read.parquet(log).count() == 1


def test_first_seen(spark, sf):
    assert first_seen(table(spark, sf, "disclosures")).count() > 0


def test_schedule():
    s = State(last=dt.date(2026, 8, 19))
    assert s.to_read(dt.date(2026, 8, 24)) == [dt.date(2026, 8, 20), dt.date(2026, 8, 21), dt.date(2026, 8, 24)]
    s.failed(dt.date(2026, 8, 18))
    assert s.to_read(dt.date(2026, 8, 20)) == [dt.date(2026, 8, 18), dt.date(2026, 8, 20)]
    s.none_published(dt.date(2026, 8, 18))
    assert s.closed == set()  # a day that once failed is tried again
    s.done(dt.date(2026, 8, 18))
    assert s.last == dt.date(2026, 8, 19) and s.pending == set() and s.earliest == dt.date(2026, 8, 18)
    s.none_published(dt.date(2026, 8, 17))
    assert s.to_fill(dt.date(2026, 8, 12)) == [dt.date(2026, 8, 14), dt.date(2026, 8, 13), dt.date(2026, 8, 12)]
    assert len(State(last=dt.date(2026, 1, 1)).to_read(dt.date(2026, 8, 1))) == 10


def test_gate_and_hold(spark):
    ok = spark.createDataFrame([("a", "ok"), ("b", "warn")], "check string, status string")
    quality.gate(ok)
    assert quality.summarise(ok).first().overall == "warn"
    with pytest.raises(ValueError, match="c"):
        quality.gate(ok.union(spark.createDataFrame([("c", "fail")], "check string, status string")))
    batch = spark.createDataFrame([(1, "a", "going_concern", "There is no substantial doubt."), (2, "b", "going_concern", "Losses raise substantial doubt."), (3, "c", "late_filing", None), (4, "d", "going_concern", "There is no substantial doubt.")], "seq long, id string, signal_type string, quote string")
    log = spark.createDataFrame([("d",)], "id string")
    stones = spark.createDataFrame([], "event_id string, action string")
    good, held = quality.screen(batch, log, stones)
    assert sorted(r.id for r in good.collect()) == ["b", "c"] and [r.id for r in held.collect()] == ["a"]


def test_strict_holds(spark):
    whole = spark.createDataFrame([("a", "x", D, D, "u", "r")], "accession string, signal_type string, filed date, scan_day date, source_url string, reason string")
    assert quality.strict_holds(whole).count() == 1
    broken = spark.createDataFrame([("a", "x", D, D, "", "r")], whole.schema)
    with pytest.raises(Exception, match="hold without a field"):
        quality.strict_holds(broken).collect()


def test_hook(spark):
    e = events(spark, (1, "a", "x", D))
    assert hooks.apply(e).collect() == e.collect()

    class Loses:
        def enrich(self, df):
            return df.drop("id")

    with pytest.raises(ValueError):
        hooks.apply(e, Loses())
