"""Daily filing indexes: the fixed-width and the pipe-separated form, and the choice between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import iso_date

#: The line formats of the two indexes.
FORM_LINE = r"^(.+?)\s+(\d{1,10})\s+(\d{8}|\d{4}-\d{2}-\d{2})\s+(edgar/\S+)\s*$"
MASTER_LINE = r"^(\d{1,10})\|([^|]*)\|([^|]*)\|(\d{8}|\d{4}-\d{2}-\d{2})\|(edgar/\S+)\s*$"
ACCESSION = r"(\d{10}-\d{2}-\d{6})"


def _filing(lines: DataFrame, form: Column, company: Column, cik: Column, day: Column, path: Column, keep: list[str]) -> DataFrame:
    return lines.select(
        *keep, F.trim(form).alias("form"), F.trim(company).alias("company"), F.try_cast(cik, "long").alias("cik") if hasattr(F, "try_cast") else cik.cast("long").alias("cik"),
        iso_date(F.translate(day, "-", "")).alias("filed"), path.alias("path"), F.regexp_extract(path, ACCESSION, 1).alias("accession"),
    )


def parse_form_index(lines: DataFrame, line: str = "value") -> DataFrame:
    """(form, company, cik, filed, path, accession) of each fixed-width line; preamble, headings and malformed lines are left out.

    The line is read from the right, because forms and companies hold blanks; two blanks part form and company.
    """
    part = lambda i: F.regexp_extract(line, FORM_LINE, i)
    head = part(1)
    keep = [c for c in lines.columns if c != line]
    ok = lines.filter(F.col(line).rlike(FORM_LINE)).filter(head.rlike(r"\S\s{2,}\S"))
    parsed = _filing(ok, F.regexp_extract(head, r"^(.*?)\s{2,}", 1), F.regexp_extract(head, r"^.*?\s{2,}(.*)$", 1), part(2), part(3), part(4), keep)
    return parsed.filter("form <> '' and form <> 'Form Type' and cik is not null and filed is not null")


def parse_master_index(lines: DataFrame, line: str = "value") -> DataFrame:
    """The same columns of each pipe-separated line."""
    part = lambda i: F.regexp_extract(line, MASTER_LINE, i)
    keep = [c for c in lines.columns if c != line]
    parsed = _filing(lines.filter(F.col(line).rlike(MASTER_LINE)), part(3), part(2), part(1), part(4), part(5), keep)
    return parsed.filter("form <> '' and cik is not null and filed is not null")


def choose_source(form: DataFrame, master: DataFrame, day: str = "day", least: int = 200) -> DataFrame:
    """For each day the rows of one source: the fixed-width one if it is long enough, else the longer, of equals the first.

    Both inputs carry ``day``. A day that neither source has is absent (closed); see ``unusable_days`` for days whose
    files exist without rows.
    """
    both = form.withColumn("source", F.lit("form")).unionByName(master.withColumn("source", F.lit("master")))
    counted = both.groupBy(day, "source").agg(F.count(F.lit(1)).alias("n"))
    enough = (F.col("source") == "form") & (F.col("n") >= least)
    pick = counted.groupBy(day).agg(F.max_by("source", F.struct(enough.cast("int"), "n", (F.col("source") == "form").cast("int"))).alias("source"))
    return both.join(pick, [day, "source"], "left_semi")


def unusable_days(files: DataFrame, filings: DataFrame, day: str = "day") -> DataFrame:
    """Days whose index files exist but hold no filing: to be tried again, not closed."""
    return files.select(day).distinct().join(filings.select(day), day, "left_anti")
