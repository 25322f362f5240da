"""Duplicates of new batches against everything accepted before.

Each report is kept in a distance table: the forms its number may be written in and, with each form, the edit
distances to a few fixed pivots. Pivot k is the digit k repeated, so a form's distance to it follows from its length
and how often it holds that digit. With a swap of neighbours counted as one edit the distance is a metric: two forms one slip
apart lie at most ``RADIUS`` apart from every pivot. A batch meets the history in ranges of the first pivot's distance, the
triangle inequality on the others prunes, and what is left is verified by the true distance. Rows are appended with
their distances, which are never computed again, in buckets of their number, their id and their range; a batch reads
only the buckets it touches.

The same filing and signal is: the same number however it is written, the same id however it is written, or a
number one slip of the keyboard apart (a digit changed, left out, doubled, or two neighbours swapped) where the
agreeing fields are known and agree. A chain of such rows is one filing; its first row is the one kept.
A row whose number and id are both null or blank repeats nothing.

Slips are looked for between the full numbers and, as padding would hide a digit left out or doubled, between a number
as it was typed and the ways the other may be written (in full, without leading zeros, part by part).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.components import components
from tidemark.session import forget_later, land, shared_dir, sized

DIGITS = 18
#: A changed, missing or added digit is one edit, and so are two swapped neighbours.
RADIUS = 1
#: Pivot k repeats the digit k. Four of them bound the cells of a range, whatever the rows.
PIVOTS = tuple(k * DIGITS for k in "0123")
#: Buckets of each index of the history: what a small batch reads of it is its share of these.
BUCKETS = 8
#: Width of a range of the first pivot's distance; a form meets its own range and the two beside it.
WIDTH = 2


#: Digits of the three parts of a number.
WIDTHS = (10, 2, 6)


def _parts(spare: int) -> str:
    """Three parts of digits with something between them, each with ``spare`` digits too many at most."""
    each = [f"([0-9]{{1,{n + spare}}})" for n in WIDTHS]
    return "(?<![0-9])" + "[^0-9A-Za-z]{1,3}".join(each) + "(?![0-9])"


def _text(value: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(value, r"(?U)\s+", " ")))


def _digits(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"^.*/", ""), "[^0-9]", "")


def _pad(digits: Column, width: int) -> Column:
    return F.when(F.length(digits) > width, digits).otherwise(F.lpad(digits, width, "0"))


def _parts_in(text: Column) -> Column:
    """The three parts as they stand, between other characters; null where there are none."""
    found = lambda spare: F.nullif(F.regexp_extract(text, _parts(spare), 0), F.lit(""))
    return F.coalesce(found(0), found(1))


def _number(text: Column, parts: Column, digits: Column) -> Column:
    padded = F.concat(*[_pad(F.get(F.split(parts, "[^0-9]+"), i), n) for i, n in enumerate(WIDTHS)])
    plain = F.when(F.length(digits).between(9, DIGITS + 1), _pad(digits, DIGITS)).otherwise(F.nullif(text, F.lit("")))
    return F.when(parts.isNotNull(), padded).otherwise(plain)


def canonical_number(value: Column) -> Column:
    """The 18 digits of an accession number however it is written (19 where one is too many); other text trimmed and in capitals; null for blank."""
    text = _text(value)
    return _number(text, _parts_in(text), _digits(text))


def _bare(parts: Column) -> Column:
    """Parts between dashes, without their leading zeros."""
    return F.regexp_replace(parts, "(^|-)0+", "$1")


def _typed(number: Column, parts: Column, digits: Column) -> Column:
    """A number as typed, where that is not its 18 digits: its digits or, if its parts are told apart, the parts without leading zeros; else null."""
    as_typed = F.when(parts.isNotNull(), F.regexp_replace(parts, "[^0-9]", "")).otherwise(digits)
    short = _bare(F.regexp_replace(parts, "[^0-9]+", "-"))
    return F.when(F.length(as_typed).between(3, DIGITS + 3) & ((as_typed != number) | (F.length(number) == DIGITS + 1)), F.when(parts.isNotNull(), short).when(F.length(digits).between(9, DIGITS + 1), digits))


def canonical_id(value: Column) -> Column:
    """A hexadecimal id in lower case without prefix and blanks; null where nothing is left."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(value), r"^\s*[a-z0-9]+:", ""), "[^0-9a-f]", ""), F.lit(""))


@dataclass(frozen=True)
class Fields:
    """The columns of a report that the operator reads; others, whatever their names, are left alone."""

    order: str = "seq"
    number: str = "accession"
    id: str = "id"
    signal: str = "signal_type"
    agree: tuple[str, ...] = ("cik", "form", "filed")


def measure(rows: DataFrame, fields: Fields = Fields()) -> DataFrame:
    """The distance table of some reports: (seq, signal, number, typed, id, agree, forms), the distances with each form.

    ``agree`` is null where an agreeing field is: what is not known agrees with nothing.
    """
    agree = F.concat_ws("|", *[F.upper(F.trim(F.col(c).cast("string"))) for c in fields.agree])
    known = F.lit(True)
    for c in fields.agree:
        known = known & F.col(c).isNotNull()
    base = rows.select(
        F.col(fields.order).cast("long").alias("seq"), F.coalesce(F.col(fields.signal), F.lit("~")).alias("signal"), _text(F.col(fields.number)).alias("text"), canonical_id(F.col(fields.id)).alias("id"), F.when(known, agree).alias("agree")
    )
    base = base.withColumns({"parts": _parts_in(F.col("text")), "digits": _digits(F.col("text"))}).withColumn("number", _number(F.col("text"), F.col("parts"), F.col("digits")))
    base = base.select("seq", "signal", "number", _typed(F.col("number"), F.col("parts"), F.col("digits")).alias("typed"), "id", "agree")
    return base.withColumn("forms", _forms())


DIMS = [f"d{k}" for k in range(len(PIVOTS))]
#: Kinds of forms: the full number, another way to write it, what was typed.
FULL, WAY, TYPED = "f", "w", "t"


def _spelled_forms() -> Column:
    """array<struct<kind, form>>: the number, the ways it may be written, what was typed.

    Zeros before a number without dashes are taken for left out where there are three, as all filers have them.
    """
    n = F.col("number")
    at, parts = 1, []
    for width in WIDTHS:
        parts.append(F.substring(n, at, width))
        at += width
    proper = n.rlike(f"^[0-9]{{{DIGITS}}}$")
    form = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("form"))
    each = [form(FULL, n), form(WAY, F.when(proper & n.startswith("000"), F.substr(n, F.lit(4)))), form(WAY, F.when(proper, _bare(F.concat_ws("-", *parts)))), form(TYPED, F.col("typed"))]
    return F.filter(F.array(*each), lambda f: f["form"].isNotNull())


def pivot_distance(form: Column, pivot: str) -> Column:
    """The edit distance of a text to a repeated character: all of the longer one but the characters that are the pivot's."""
    n = F.length(form)
    return F.greatest(n, F.lit(len(pivot))) - F.least(n - F.length(F.replace(form, F.lit(pivot[0]), F.lit(""))), F.lit(len(pivot)))


def _forms() -> Column:
    """The forms with their distances to the pivots."""
    return F.transform(_spelled_forms(), lambda f: F.struct(f["kind"].alias("kind"), f["form"].alias("form"), *[pivot_distance(f["form"], p).alias(d) for d, p in zip(DIMS, PIVOTS, strict=True)]))


def _comparable(a: Column, b: Column) -> Column:
    """Full numbers with each other, what was typed with the ways of writing the other in full or short."""
    return ((a == FULL) & (b == FULL)) | ((a == TYPED) != (b == TYPED))


def _one_slip(a: Column, b: Column) -> Column:
    """At most one edit, or two neighbouring characters swapped."""
    at = F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1)))
    swapped = F.exists(at, lambda i: (F.concat(F.substr(a, F.lit(1), i - 1), F.substr(a, i + 1, F.lit(1)), F.substr(a, i, F.lit(1)), F.substr(a, i + 2)) == b))
    distance = F.levenshtein(a, b, 2)
    return distance.isin(0, 1) | ((distance == 2) & (F.length(a) == F.length(b)) & swapped)


GROUP = ["signal", "agree"]


def _range() -> Column:
    return F.floor(F.col("d0") / WIDTH)


def near_cells(pool: DataFrame) -> DataFrame:
    """(signal, agree, kind, d0, ...): the cells of forms that have a comparable form, one of the two new, within the radius on every pivot.

    ``pool`` has a row for each form, with ``fresh``. Forms of equal distances are one cell, so what is joined is bounded for
    each group by the values the distances can take, not by its rows. A range meets the ranges beside it.
    """
    cells = pool.groupBy(*GROUP, "kind", *DIMS).agg(F.count(F.lit(1)).alias("n"), F.bool_or("fresh").alias("fresh"))
    l = cells.withColumn("range", F.explode(F.array(_range() - 1, _range(), _range() + 1))).alias("l")
    r = cells.withColumn("range", _range()).hint("merge").alias("r")
    on = F.lit(True)
    for c in [*GROUP, "range"]:
        on &= F.col(f"l.{c}") == F.col(f"r.{c}")
    same = F.col("l.kind") == F.col("r.kind")
    for d in DIMS:
        on &= F.abs(F.col(f"l.{d}") - F.col(f"r.{d}")) <= RADIUS
        same &= F.col(f"l.{d}") == F.col(f"r.{d}")
    on &= _comparable(F.col("l.kind"), F.col("r.kind")) & (F.col("l.fresh") | F.col("r.fresh")) & (~same | (F.col("l.n") > 1))
    return l.join(r, on, "left_semi").select(*GROUP, "kind", *DIMS).distinct()


def slips(pool: DataFrame) -> DataFrame:
    """(a, b): links that join all nodes of forms one slip apart. ``pool`` is (signal, agree, kind, form, d0, ..., node, fresh).

    Only groups with several numbers, at least one of them new, are looked at, and of these only the cells that
    ``near_cells`` leaves. Numbers that differ in one digit share the pattern with that digit blanked, neighbours that are swapped share
    the pattern with the two in order, a number with a digit too few equals the longer one less that digit. Whoever shares
    a pattern meets the first that has it and is verified against it, so a number costs its patterns, not its neighbours, and groups of
    any size take the same way. Full numbers share patterns with each other; a pattern of what was typed and of ways
    to write links all its nodes if it has both.
    """
    full = F.when(F.col("kind") == FULL, F.xxhash64("form"))
    several = sized(pool.filter(F.col("kind") == FULL).groupBy(*GROUP).agg(F.min(full).alias("lo"), F.max(full).alias("hi"), F.bool_or("fresh").alias("fresh")).filter("lo <> hi and fresh").select(*GROUP), "groups")
    pool = pool.join(several, GROUP, "left_semi").groupBy(*GROUP, "kind", "form", *DIMS).agg(F.min("node").alias("node"), F.bool_or("fresh").alias("fresh"))
    pool = land(pool, "several")
    forms = land(pool.join(near_cells(pool).hint("merge"), [*GROUP, "kind", *DIMS], "left_semi").select(*GROUP, "kind", "form", "node"), "near")
    n = F.col("form")
    cut = lambda i, k, mid: F.concat(F.substr(n, F.lit(1), i - 1), mid, F.substr(n, i + k))
    at, pairs = F.sequence(F.lit(1), F.length(n)), F.sequence(F.lit(1), F.greatest(F.length(n) - 1, F.lit(1)))
    one = lambda i: F.substr(n, i, F.lit(1))
    named = lambda mark, i, body: F.concat(F.lit(mark), i.cast("string"), F.lit(":"), body)
    blanked = F.transform(at, lambda i: named("b", i, cut(i, 1, F.lit("?"))))
    ordered = F.transform(pairs, lambda i: named("s", i, cut(i, 2, F.concat(F.least(one(i), one(i + 1)), F.greatest(one(i), one(i + 1))))))
    shared = forms.select(*GROUP, "node", "kind", "form", F.explode(F.concat(blanked, ordered)).alias("pattern"))
    by = [*GROUP, "pattern"]

    def linked(members: DataFrame, least: Column) -> DataFrame:
        first = members.groupBy(*by).agg(F.min(F.struct("node", "form")).alias("b"), F.max("node").alias("top"), least.alias("kinds")).filter("b.node < top and kinds").select(*by, "b")
        met = members.join(first.hint("merge"), by).filter("node <> b.node")
        return met.filter(_one_slip(F.col("form"), F.col("b.form"))).select(F.col("node").alias("a"), F.col("b.node").alias("b"))

    alike = linked(shared.filter(F.col("kind") == FULL), F.lit(True)).unionByName(linked(shared, F.bool_or(F.col("kind") == TYPED) & F.bool_or(F.col("kind") != TYPED)))
    shorter = forms.select(*GROUP, "kind", F.col("node").alias("a"), F.explode(F.array_distinct(F.transform(at, lambda i: cut(i, 1, F.lit(""))))).alias("form"))
    longer = forms.select(*GROUP, "form", F.col("kind").alias("other"), F.col("node").alias("b")).hint("merge")
    missing = shorter.join(longer, [*GROUP, "form"]).filter(_comparable(F.col("kind"), F.col("other")) & (F.col("a") != F.col("b"))).select("a", "b")
    return alike.unionByName(missing).distinct()


_ROWS = "seq long, root long, batch string"
_KEYS = "signal string, key string, kind string, form string, " + ", ".join(f"{d} int" for d in DIMS) + ", root long, batch string, of string, bucket int"
_JOINS = "old long, now long, batch string"
#: What the index is of: numbers, ids, and the forms of the numbers of a group with their distances.
NUMBER, ID, FORM = "n", "i", "f"


class DistanceTable:
    """The accepted history on disk; a batch that is accepted again replaces itself.

    ``rows`` holds each row with the first row of its filing as it was when the row came; ``index`` the numbers, ids and
    forms with their distances, each once for a batch with the first row, in buckets; ``joins`` the first rows
    that gave way to others as later batches joined their filings, each with the one that stands for it now.
    """

    def __init__(self, spark: SparkSession, path: str, fields: Fields = Fields(), buckets: int = BUCKETS):
        self.spark, self.path, self.fields, self.buckets = spark, path.rstrip("/"), fields, buckets

    def _exists(self, path: str) -> bool:
        fs_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return fs_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path)

    def _read(self, part: str, schema: str, without: str | None) -> DataFrame:
        if self._exists(f"{self.path}/{part}"):
            read = self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        else:
            read = self.spark.createDataFrame([], schema)
        return read if without is None else read.filter(F.col("batch") != without)

    def _write(self, df: DataFrame, part: str, name: str, *by: str) -> None:
        (df.hint("rebalance", *by) if by else df).write.partitionBy(*by).mode("overwrite").parquet(f"{self.path}/{part}/batch={name}")

    def _bucket(self, *of: Column | str) -> Column:
        return F.pmod(F.xxhash64(*of), F.lit(self.buckets)).cast("int")

    def _now(self, roots: DataFrame, without: str | None) -> DataFrame:
        """Roots of the history as they are after all joins so far."""
        joins = self._read("joins", _JOINS, without).groupBy(F.col("old").alias("root")).agg(F.min("now").alias("now"))
        return roots.join(joins.hint("merge"), "root", "left").withColumn("root", F.coalesce("now", "root")).drop("now")

    def links(self) -> DataFrame:
        """(kept_seq, dup_seq): every accepted row that repeats an earlier one, with the first of its filing."""
        rows = self._now(self._read("rows", _ROWS, None), None)
        return rows.filter("root < seq").select(F.col("root").alias("kept_seq"), F.col("seq").alias("dup_seq")).distinct()

    def _entries(self, new: DataFrame) -> DataFrame:
        """The index entries of a batch: (of, signal, key, kind, form, d0, ..., bucket, seq); a row that has none keeps an empty one."""
        bare = lambda of, key: F.struct(F.lit(of).alias("of"), key.alias("key"), *[F.lit(None).cast("string").alias(c) for c in ("kind", "form")], *[F.lit(None).cast("int").alias(d) for d in DIMS], self._bucket(key).alias("bucket"))
        forms = F.transform("forms", lambda f: F.struct(F.lit(FORM).alias("of"), F.col("agree").alias("key"), f["kind"].alias("kind"), f["form"].alias("form"), *[f[d].alias(d) for d in DIMS], self._bucket(F.col("agree"), F.floor(f["d0"] / WIDTH)).alias("bucket")))
        each = F.filter(F.concat(F.array(bare(NUMBER, F.col("number")), bare(ID, F.col("id"))), forms), lambda x: x["key"].isNotNull())
        return new.select("seq", "signal", F.inline_outer(each))

    def _touched(self, entries: DataFrame, name: str) -> DataFrame:
        """What of the history's index shares a number, an id or a group and range with the batch, with the roots of today."""
        beside = F.when(F.col("of") == FORM, F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: self._bucket(F.col("key"), F.floor(F.col("d0") / WIDTH) + k))).otherwise(F.array("bucket"))
        asked = entries.select("of", F.explode(beside).alias("bucket")).groupBy("of").agg(F.collect_set("bucket").alias("b")).collect()  # as many as there are buckets
        held = self._read("index", _KEYS, name)
        some = F.lit(False)
        for r in asked:
            some |= (F.col("of") == r.of) & F.col("bucket").isin(r.b)
        by = ["of", "key", "signal"]
        return self._now(held.filter(some).drop("batch", "bucket").join(entries.select(*by).distinct().hint("merge"), by, "left_semi"), name)

    def accept(self, batch: DataFrame, name: str) -> DataFrame:
        """Links (kept_seq, dup_seq) of a batch against history and itself; the batch is then part of the history.

        Of the history only the buckets that the batch's numbers, ids and ranges fall in are read, and of these only the
        filings met. Older rows whose first row is another one now, as the batch joins their filings, are linked
        anew; the links come from files written here, when they are asked for.
        """
        all_ = land(self._entries(measure(batch, self.fields)), "batch")
        entries = all_.filter("of is not null")
        known = self._exists(f"{self.path}/rows")
        columns = ["of", "key", "signal", "kind", "form", *DIMS]
        met = entries.select(*columns, F.col("seq").alias("node"), F.lit(True).alias("fresh"))
        if known:
            met = met.unionByName(land(self._touched(entries, name), "touched").select(*columns, F.col("root").alias("node"), F.lit(False).alias("fresh")))
        by = ["of", "key", "signal"]
        nodes = met.filter(F.col("of") != FORM).select(*by, "node")
        heads = sized(nodes.groupBy(*by).agg(F.min("node").alias("b"), F.max("node").alias("top")).filter("b < top").drop("top"), "heads")
        equal = nodes.join(heads, by).filter("node <> b").select(F.col("node").alias("a"), "b")
        pool = met.filter(F.col("of") == FORM).select("signal", F.col("key").alias("agree"), "kind", "form", *DIMS, "node", "fresh")
        found = sized(components(equal.unionByName(slips(pool))).filter("node <> root"), "found")
        mine = all_.select("seq").distinct()
        with_root = lambda df: df.join(found.withColumnRenamed("node", "seq"), "seq", "left").withColumn("root", F.coalesce("root", "seq"))
        self._write(with_root(mine), "rows", name)
        rooted = self.spark.read.schema("seq long, root long").parquet(f"{self.path}/rows/batch={name}")
        self._write(with_root(entries).groupBy(*columns, "bucket").agg(F.min("root").alias("root")), "index", name, "of", "bucket")
        fresh = rooted.filter("root < seq").select(F.col("root").alias("kept_seq"), F.col("seq").alias("dup_seq"))
        if not known:
            return fresh.distinct()
        moved = found.join(mine.select(F.col("seq").alias("node")).hint("merge"), "node", "left_anti")
        gone = moved.select(F.col("node").alias("old"), F.col("root").alias("now"))
        further = self._read("joins", _JOINS, name).select("old", F.col("now").alias("node")).join(moved.hint("merge"), "node").select("old", F.col("root").alias("now"))
        gone = land(gone.unionByName(further).distinct(), "gone")
        older = self._now(self._read("rows", _ROWS, name), name).join(moved.select(F.col("node").alias("root"), F.col("root").alias("kept_seq")).hint("merge"), "root").select("kept_seq", F.col("seq").alias("dup_seq"))
        self._write(gone, "joins", name)
        return fresh.unionByName(older).distinct()


#: Calls in which ``fold`` takes a log that is there already: each is one batch of many days, and later ones meet the table that earlier ones wrote.
FOLDS = 2


def fold(rows: DataFrame, day: str, fields: Fields = Fields(), folds: int = FOLDS, path: str | None = None) -> DataFrame:
    """(kept_seq, dup_seq) of a log whose batches are its days, taken through a ``DistanceTable`` in the order of the days.

    Days are accepted in ``folds`` runs of about as many rows each, rows without a day with the first; how days are
    grouped changes what it costs, not what comes out. The table goes to ``path``, or to the shared folder for this session.
    """
    spark = rows.sparkSession
    if path is None:
        path = forget_later(spark, f"{shared_dir(spark)}/tidemark-history")
    kept = rows.select(*{fields.order, fields.number, fields.id, fields.signal, *fields.agree, day})
    sizes = [(r.d, r.n) for r in kept.groupBy(F.col(day).alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("d is not null").orderBy("d").collect()]  # as many as the calendar has days
    total, run, ends = sum(n for _, n in sizes), 0, []
    for d, n in sizes:
        run += n
        if len(ends) + 1 < folds and run >= (len(ends) + 1) * total / folds:
            ends.append(d)
    table = DistanceTable(spark, path, fields)
    for i in range(len(ends) + 1):
        part = F.lit(True) if i == len(ends) else (F.col(day) <= ends[i]) | F.col(day).isNull()
        if i:
            part &= F.col(day) > ends[i - 1]
        table.accept(kept.filter(part), f"{i:04d}")
    return table.links()
