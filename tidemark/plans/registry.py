"""Query name -> callable, and query name -> the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where SQL can say it."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


_MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
_BLANK = r"\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def plain_sql(column: str) -> str:
    """``normalise_for_diff`` in SQL. Without lookarounds a word takes what stands beside it, so each pass is made twice for neighbours."""
    out = rf"regexp_replace(lower({column}), '\b\d[\d,.]*\b', ' ', 'g')"
    for words in (f"(?:{_MONTHS})", f"(?:first|second|third|fourth)[{_BLANK}]+quarter"):
        for _ in range(2):
            out = rf"regexp_replace({out}, '(^|[^\p{{L}}\p{{N}}_]){words}($|[^\p{{L}}\p{{N}}_])', '\1 \2', 'g')"
    return f"regexp_replace(regexp_replace({out}, '[^a-z ]+', ' ', 'g'), ' +', ' ', 'g')"


for _module in ("log", "filings", "corpus", "star", "cases"):
    import_module(f"tidemark.plans.{_module}")
