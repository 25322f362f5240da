"""A plug for enrichment of new events; what ships changes nothing."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame


class Enricher(Protocol):
    """Takes new events and returns them, with more in them or fewer of them; it keeps the columns."""

    def enrich(self, events: DataFrame) -> DataFrame: ...


class Unchanged:
    def enrich(self, events: DataFrame) -> DataFrame:
        return events


def apply(events: DataFrame, enricher: Enricher | None = None) -> DataFrame:
    out = (enricher or Unchanged()).enrich(events)
    missing = set(events.columns) - set(out.columns)
    if missing:
        raise ValueError(f"the enricher lost columns: {sorted(missing)}")
    return out.select(*events.columns)
