"""Which days to read next: catch-up, retries, and filling backwards. Control only; a handful of dates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

CATCH_UP, FILL = 10, 12


def business_days(first: dt.date, last: dt.date) -> list[dt.date]:
    return [d for i in range((last - first).days + 1) if (d := first + dt.timedelta(i)).weekday() < 5]


@dataclass
class State:
    """Water marks and memory of a run. ``last`` moves only over days read in full."""

    last: dt.date | None = None
    earliest: dt.date | None = None
    pending: set[dt.date] = field(default_factory=set)
    closed: set[dt.date] = field(default_factory=set)

    def to_read(self, horizon: dt.date, most: int = CATCH_UP) -> list[dt.date]:
        """Days to read now, oldest first: those to retry and those since the last, bounded by a run's capacity."""
        since = business_days(self.last + dt.timedelta(1), horizon) if self.last else [horizon]
        return sorted({d for d in since if d not in self.closed} | {d for d in self.pending if d <= horizon})[:most]

    def to_fill(self, floor: dt.date, most: int = FILL) -> list[dt.date]:
        """Days before the earliest read, newest first, down to a floor, without closed ones."""
        if self.earliest is None or self.earliest <= floor:
            return []
        days = [d for d in business_days(floor, self.earliest - dt.timedelta(1)) if d not in self.closed]
        return days[::-1][:most]

    def done(self, day: dt.date) -> None:
        """A day was read in full."""
        self.pending.discard(day)
        self.last = max(self.last or day, day)
        self.earliest = min(self.earliest or day, day)

    def failed(self, day: dt.date) -> None:
        """A day could not be read: try again."""
        self.pending.add(day)

    def none_published(self, day: dt.date) -> None:
        """No index exists for the day. A day that once failed is tried again instead: its index may only be late."""
        if day in self.pending:
            return
        self.closed.add(day)
        self.earliest = min(self.earliest or day, day)
