import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.llm import batches
from tidemark.session import table

SCHEMA = "seq long, id string, accession string, signal_type string, cik long, form string, filed date, number string"
D = dt.date(2024, 1, 2)


def rows(spark, data):
    return spark.createDataFrame([(*r, "clash") for r in data], SCHEMA)


def links(df, **how):
    return {(r.kept_seq, r.dup_seq) for r in batches.fold(df, "filed", **how).collect()}


@pytest.mark.parametrize(
    "text",
    ["0009003554-23-000040", "000900355423000040", "9003554-23-40", "900355423000040", "ACC-NO 0009003554-23-000040", "edgar/data/7002014/0009003554-23-000040.txt", "0009003554_23_000040", " 0009003554/23/000040", "0009003554–23–000040", "0009003554 23 000040", "0009003554-23-000040-index.htm"],
)
def test_number_however_written(spark, text):
    assert spark.range(1).select(batches.canonical_number(F.lit(text)).alias("n")).first().n == "000900355423000040"


def test_id_however_written(spark):
    for text in ("1B7E0E32456B8353", "sha1:1b7e0e32456b8353", " 1b7e0e32456b8353", "1b7e0e32456b8353\n"):
        assert spark.range(1).select(batches.canonical_id(F.lit(text)).alias("n")).first().n == "1b7e0e32456b8353"


def test_cases(spark):
    a = "0009003554-23-000040"
    df = rows(
        spark,
        [
            (1, "aa", a, "x", 7, "8-K", D),
            (2, "bb", "000900355423000040", "x", 7, "8-K", D),  # same number
            (3, "AA ", "0009003999-23-000001", "x", 7, "8-K", D),  # same id
            (4, "cc", "0009003554-23-000041", "x", 7, "8-K", D),  # one digit
            (5, "dd", "0009003554-32-000040", "x", 7, "8-K", D),  # swapped
            (6, "ee", "0009003554-23-000049", "x", 7, "8-K/A", D),  # amendment
            (7, "ff", "0009003554-23-000048", "x", 8, "8-K", D),  # another company
            (8, "gg", a, "y", 7, "8-K", D),  # another signal
            (9, None, None, "x", 7, "8-K", D),
            (10, None, " ", "x", 7, "8-K", D),
            (11, "hh", "0009003999-23-000010", "x", 9, "8-K", None),
            (12, "ii", "0009003999-23-000018", "x", 9, "8-K", None),  # dates that are not known do not agree
            (13, "jj", "0009003554-23-000062", "x", 7, "8-K", D),  # two digits off
            (14, "kk", "0009003999-23-000018", "x", 1, "10-K", D),  # same number, all else another
        ],
    )
    assert links(df) == {(1, 2), (1, 3), (1, 4), (1, 5), (12, 14)}


def test_empty(spark):
    assert links(rows(spark, [])) == set()


def _brute(data):
    """All pairs, over the same canonical forms."""
    root = {r["seq"]: r["seq"] for r in data}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def slip(a, b):
        if len(a) != len(b):
            return False
        off = [i for i in range(len(a)) if a[i] != b[i]]
        return len(off) == 1 or (len(off) == 2 and off[1] == off[0] + 1 and a[off[0]] == b[off[1]] and a[off[1]] == b[off[0]])

    for i, a in enumerate(data):
        for b in data[:i]:
            if a["signal"] == b["signal"] and ((a["number"] and a["number"] == b["number"]) or (a["id"] and a["id"] == b["id"]) or (a["agree"] and a["agree"] == b["agree"] and a["number"] and b["number"] and slip(a["number"], b["number"]))):
                x, y = find(a["seq"]), find(b["seq"])
                root[max(x, y)] = min(x, y)
    return {(find(s), s) for s in root if find(s) < s}


def test_bulk_equals_brute_force_and_batches(spark, sf, tmp_path):
    df = table(spark, sf.replace("sf0.001", "sf0.01"), "disclosures").filter("seq <= 700 or accession not rlike '^[0-9]{10}-[0-9]{2}-[0-9]{6}$'")
    measured = [r.asDict() for r in batches.measure(df).orderBy("seq").collect()]
    bulk = links(df)
    assert bulk == _brute(measured) and bulk
    store = batches.DistanceTable(spark, str(tmp_path / "history"))
    got, cuts = set(), [0, 300, 600, 10**9]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        for _ in range(2 if lo == 300 else 1):  # a batch that is run again replaces itself
            part = {(r.kept_seq, r.dup_seq) for r in store.accept(df.filter(f"seq > {lo} and seq <= {hi}"), str(lo)).collect()}
        got |= part
    assert got == bulk


def test_a_large_group_of_agreeing_fields(spark):
    import random

    rng = random.Random(9)
    numbers = {f"{rng.choice(['0009000001', '0009000010'])}{rng.choice(['23', '32'])}{rng.randrange(10**6) % 300 * 7:06d}" for _ in range(160)} | {"12345678901234567X", "1234567890123456X", "12345678901234567"}
    data = [(i, f"{i:x}a", n, "x", 7, "8-K", D) for i, n in enumerate(sorted(sorted(numbers), key=lambda n: rng.random()))]
    df = rows(spark, data)
    measured = batches.measure(df)
    got = links(df)
    root = {d[0]: d[0] for d in data}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def edits(s):
        for i in range(len(s)):
            yield s[:i] + s[i + 1 :]
            if i + 1 < len(s):
                yield s[:i] + s[i + 1] + s[i] + s[i + 2 :]

    at = {}
    for r in measured.orderBy("seq").collect():
        root[find(r.seq)] = find(at.setdefault(r.number, r.seq))
    for n, i in at.items():
        near = {m for m in edits(n)} | {n[:k] + c + n[k + 1 :] for k in range(len(n)) for c in "0123456789X"}
        for m in near:
            if m in at and m != n:
                x, y = find(i), find(at[m])
                root[max(x, y)] = min(x, y)
    assert got == {(find(i), i) for i in root if find(i) < i} and got


def test_left_out_and_doubled_digits_however_typed(spark):
    full, typed = "0009006316-24-002268", ["0009006316-24-002268", "000900631624002268", "0009006316_24_002268", "9006316-24-2268", "900631624002268"]
    slips = [(t, t[:i] + c + t[i + 1 :]) for t in typed for i in range(len(t)) if t[i].isdigit() for c in ("", t[i] * 2)]
    data = [r for k, (_, s) in enumerate(slips) for r in ((2 * k, f"{2 * k:x}a", full, f"x{k}", k, "8-K", D), (2 * k + 1, f"{2 * k + 1:x}b", s, f"x{k}", k, "8-K", D))]
    got = links(rows(spark, data))
    assert not [slips[k] for k in range(len(slips)) if (2 * k, 2 * k + 1) not in got] and len(got) == len(slips)


def test_padding_makes_no_slip(spark):
    pairs = [("0009006316-24-000140", "0009006316-24-000014"), ("000900631624000140", "0009006316-24-000014"), ("0009006316-24-002268", "0090063160-24-002268"), ("0009006316-24-002268", "00090063-24-002268")]
    data = [(2 * k + side, f"{2 * k + side:x}a", n, "x", k, "8-K", D) for k, p in enumerate(pairs) for side, n in enumerate(p)]
    got = links(rows(spark, data))
    assert got == {(0, 2), (1, 3), (4, 6)}  # the same numbers, however written


def test_a_batch_that_joins_two_accepted_filings(spark, tmp_path):
    x, y = "0009003554-23-000040", "0009003999-23-000777"
    data = [(1, "a", x, "x", 7, "8-K", D), (2, "b", y, "x", 7, "8-K", D), (3, "b", x, "x", 7, "8-K", D), (4, "d", y, "x", 7, "8-K", D)]
    store = batches.DistanceTable(spark, str(tmp_path / "history"))
    got = [{(r.kept_seq, r.dup_seq) for r in store.accept(rows(spark, part), name).collect()} for name, part in (("1", data[:2]), ("2", data[2:3]), ("2", data[2:3]), ("3", data[3:]))]
    assert got == [set(), {(1, 2), (1, 3)}, {(1, 2), (1, 3)}, {(1, 4)}]
    assert set().union(*got) == links(rows(spark, data))


def test_four_batches_and_a_swap_in_short_numbers(spark, tmp_path):
    data = [(1, "aaaa", "0009003554-23-000111", "x", 1, "8-K", D), (2, "bbbb", "0009003554-23-999999", "x", 2, "8-K", D), (3, "bbbb", "0009003554-23-000111", "x", 3, "8-K", D), (4, "cccc", "0009003554-23-999999", "x", 4, "8-K", D)]
    store = batches.DistanceTable(spark, str(tmp_path / "history"), buckets=3)
    got = [{(r.kept_seq, r.dup_seq) for r in store.accept(rows(spark, [d]), str(d[0])).collect()} for d in data]
    assert got == [set(), set(), {(1, 2), (1, 3)}, {(1, 4)}]
    assert {(r.kept_seq, r.dup_seq) for r in store.links().collect()} == links(rows(spark, data)) == {(1, 2), (1, 3), (1, 4)}
    short = [(1, "aaaa", "AB12", "x", 7, "8-K", D), (2, "bbbb", "BA12", "x", 7, "8-K", D), (3, "cccc", "CD12", "x", 7, "8-K", D)]
    assert links(rows(spark, short)) == {(1, 2)}


def test_joins_of_joins(spark, tmp_path):
    """Filings 10, 20 and 30 are joined from the last to the first, each by a later batch."""
    n = lambda k: f"0009003554-23-{k:06d}"
    data = [(10, "a", n(111), "x", 1, "8-K", D), (20, "b", n(555), "x", 2, "8-K", D), (30, "c", n(999), "x", 3, "8-K", D), (40, "c", n(555), "x", 4, "8-K", D), (50, "b", n(111), "x", 5, "8-K", D), (60, "zz", n(999), "x", 6, "8-K", D)]
    store = batches.DistanceTable(spark, str(tmp_path / "history"), buckets=2)
    got = [{(r.kept_seq, r.dup_seq) for r in store.accept(rows(spark, [d]), str(d[0])).collect()} for d in data]
    assert got == [set(), set(), set(), {(20, 30), (20, 40)}, {(10, 20), (10, 30), (10, 40), (10, 50)}, {(10, 60)}]
    assert {(r.kept_seq, r.dup_seq) for r in store.links().collect()} == {(10, k) for k in (20, 30, 40, 50, 60)}


def test_random_batches_equal_one_batch_and_brute_force(spark, tmp_path):
    import random

    rng = random.Random(3)
    base = [f"0009000{rng.randrange(3):03d}-2{rng.randrange(3)}-{rng.randrange(30) * 7:06d}" for _ in range(40)]
    data = [(i, rng.choice(["a", "b", "c"]) * 3 + str(i % 60) if rng.random() < 0.9 else None, rng.choice(base) if rng.random() < 0.95 else None, rng.choice("xy"), rng.randrange(3), "8-K", D if rng.random() < 0.9 else None) for i in range(120)]
    df = rows(spark, data)
    want = _brute([r.asDict() for r in batches.measure(df).orderBy("seq").collect()])
    assert want and links(df, folds=1) == want
    store = batches.DistanceTable(spark, str(tmp_path / "history"), buckets=4)
    said: dict[int, int] = {}
    for k, (lo, hi) in enumerate(((0, 50), (50, 70), (70, 120))):
        said.update({r.dup_seq: r.kept_seq for r in store.accept(df.filter(f"seq >= {lo} and seq < {hi}"), str(k)).collect()})
    assert {(b, a) for a, b in said.items()} == want == {(r.kept_seq, r.dup_seq) for r in store.links().collect()}


def test_pivot_distances_are_edit_distances(spark):
    texts = ["", "0", "000900355423000040", "0009003554230000400", "9003554-23-40", "AB12", "1111111111111111111112", "3" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for p in batches.PIVOTS:
        assert df.filter(batches.pivot_distance(F.col("t"), p) != F.levenshtein("t", F.lit(p))).count() == 0


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    data = [(i, f"{i:08x}", f"0009003554-23-{i:06d}", "x", i, "8-K", D) for i in range(1, 200)]
    store = batches.DistanceTable(spark, str(tmp_path / "history"))
    store.accept(rows(spark, data), "1")
    seen = []
    kept = batches.DistanceTable._read
    try:
        batches.DistanceTable._read = lambda self, part, schema, without: (lambda df: seen.append((part, df)) or df)(kept(self, part, schema, without))
        store.accept(rows(spark, [(1000, "00000005", "0009003554-23-000007", "x", 7, "8-K", D)]), "2").collect()
    finally:
        batches.DistanceTable._read = kept
    assert {(r.kept_seq, r.dup_seq) for r in store.links().collect()} == {(5, 7), (5, 1000)}
    folders = {f.name for f in (tmp_path / "history" / "index" / "batch=1" / "of=n").iterdir()}
    assert len(folders) == batches.BUCKETS
