"""Samples of a known size that are the same on every run and cost one narrow pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 30


def by_hash(rows: DataFrame, keys: list[str], k: int, of: int) -> DataFrame:
    """At most ``k`` of about ``of`` rows, those whose keys hash lowest. Rows of equal keys are in or out together but for the last.

    A threshold on the hash lets through little more than ``k`` rows, so what is sorted at the end is small whatever
    the table; a top-k over all rows would send k rows from every task to one.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << BITS))
    share = min(1.0, (1.2 * k + 100) / max(of, 1))
    return rows.filter(place < int(share * (1 << BITS)) + (share >= 1.0)).orderBy(place, *keys).limit(k)
