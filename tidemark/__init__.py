"""Disclosure-change analytics on Spark: filings in, a de-duplicated log of changes and its derived views out."""

__version__ = "0.1.0"
