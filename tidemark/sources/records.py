"""Headers, submission histories, value frames and the stored event log, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions.scalars import iso_date
from tidemark.operators.dedupe import first_of, withdrawn


def header_fields(text: Column) -> list[Column]:
    """Item codes in order and once each, industry, conformed name and period of a tagged filing header."""
    one = lambda tag: F.trim(F.regexp_extract(text, rf"(?m)<{tag}>[ \t]*([^\r\n<]*)", 1))
    return [
        F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(?m)<ITEMS>[ \t]*([^\r\n<]+)"), F.lit(1)), lambda i: F.trim(i))).alias("items"),
        F.nullif(one("ASSIGNED-SIC"), F.lit("")).cast("int").alias("sic"),
        one("CONFORMED-NAME").alias("name"),
        iso_date(one("PERIOD")).alias("period"),
    ]


def enrich(filings: DataFrame, headers: DataFrame) -> DataFrame:
    """Filings with their header's fields; a filing whose header could not be read is left out, its company filled only where empty."""
    h = headers.select("accession", *header_fields(F.col("header")))
    company = F.coalesce(F.nullif(F.trim("company"), F.lit("")), F.nullif("name", F.lit("")))
    return filings.drop("items", "sic", "period").join(h, "accession").withColumn("company", company).drop("name")


def submissions(blocks: DataFrame, arrays: tuple[str, ...] = ("accessionNumber", "filingDate", "form", "items")) -> DataFrame:
    """Parallel arrays to rows. A company with a block of ragged or missing arrays fails whole: half a history is none."""
    even = F.lit(True)
    for a in arrays:
        even = even & F.coalesce(F.size(a) == F.size(arrays[0]), F.lit(False))
    judged = blocks.withColumn("_even", even)
    whole = judged.groupBy("cik").agg(F.bool_and("_even").alias("_ok")).filter("_ok")
    good = judged.filter("_even").join(whole.select("cik"), "cik", "left_semi")
    return good.select("cik", F.inline(F.arrays_zip(*arrays)))


def item_list(items: Column) -> Column:
    """A comma-separated list of codes as a trimmed array without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(items, F.lit("")), ","), lambda i: F.trim(i)), lambda i: i != "")


def frame_values(frames: DataFrame, entity: str = "cik", value: str = "val") -> DataFrame:
    """(entity, value): the largest positive value over all periods. ``frames`` has one exploded row a value."""
    return frames.filter(F.col(value) > 0).groupBy(entity).agg(F.max(value).alias(value))


def quarter_frames(spark: SparkSession, n: int, today: str) -> DataFrame:
    """The names of the latest n completed quarter-ends, newest first."""
    q = F.trunc(F.lit(today).cast("date"), "quarter")
    ends = spark.range(n).select("id", F.date_sub(F.add_months(q, (-3 * F.col("id")).cast("int")), 1).alias("end"))
    return ends.select("id", F.concat(F.lit("CY"), F.year("end"), F.lit("Q"), F.quarter("end"), F.lit("I")).alias("frame"))


def concept_max(concepts: DataFrame) -> DataFrame:
    """(cik, value): the largest value over every unit of a map<unit, array<struct<val>>>."""
    return concepts.select("cik", F.explode(F.flatten(F.map_values("units"))).alias("u")).groupBy("cik").agg(F.max("u.val").alias("value"))


def read_log(spark: SparkSession, path: str, tombstones: DataFrame | None = None) -> DataFrame:
    """The stored log from its JSON lines: lines that are no JSON (merge marks) and rows without an id are left out, the
    first row of an id and day kept, withdrawn ids dropped."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    raw = lines.filter(F.col("value").startswith("{"))
    parsed = raw.select("file", "line", F.from_json("value", schema.EVENT, {"mode": "PERMISSIVE"}).alias("e")).filter("e.id is not null and e.accession is not null")
    first = first_of(parsed.select(F.col("e.id").alias("_id"), "file", "line", "e"), ["_id", "file"], "line").select("e.*")
    return first.join(withdrawn(tombstones), "id", "left_anti").select(*schema.EVENT.names) if tombstones is not None else first


def raw_rows(spark: SparkSession, path: str) -> DataFrame:
    """How many lines of the log hold a row."""
    return spark.read.text(path).filter(F.col("value").startswith("{")).agg(F.count(F.lit(1)).alias("rows"))


def newest_first(events: DataFrame, limit: int | None = None) -> DataFrame:
    ordered = events.orderBy(F.desc_nulls_last("filed"), F.desc_nulls_last("company"), F.asc("seq"))
    return ordered.limit(limit) if limit else ordered


def read_letters(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of PDF letters, pages joined and blanks collapsed; needs the optional package ``pypdf`` on the executors."""
    import io

    import pyarrow as pa
    from pyspark.sql.types import StringType

    from tidemark.functions.text import collapse
    from tidemark.session import arrow

    @arrow(StringType())
    def pages(content: pa.Array) -> pa.Array:
        from pypdf import PdfReader

        return pa.array([None if b is None else " ".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(b)).pages) for b in content.to_pylist()], pa.string())

    return spark.read.format("binaryFile").load(path).select("path", collapse(pages("content")).alias("text"))
