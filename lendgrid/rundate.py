"""Run parameter of one ledger load and the dates derived from it."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _add_months(d: dt.date, months: int) -> dt.date:
    """Calendar month shift with the day clamped to the target month's length
    (the meaning of Spark's ``add_months``)."""
    m0 = d.year * 12 + (d.month - 1) + months
    year, month = divmod(m0, 12)
    month += 1
    day = min(d.day, calendar.monthrange(year, month)[1])
    return dt.date(year, month, day)


@dataclass(frozen=True)
class RunDate:
    """Business date ``D`` of a run plus the derived keys every read needs.

    All derived values are Python constants, so Catalyst sees literals and can
    push them into Parquet scans and prune ``partid`` directories.
    """

    d: dt.date

    @classmethod
    def parse(cls, value: str | dt.date) -> "RunDate":
        if isinstance(value, dt.datetime):
            return cls(value.date())
        if isinstance(value, dt.date):
            return cls(value)
        text = value.strip().replace("/", "-")
        if len(text) == 8 and text.isdigit():
            return cls(dt.datetime.strptime(text, "%Y%m%d").date())
        return cls(dt.date.fromisoformat(text))

    @property
    def d8(self) -> str:
        """``yyyyMMdd`` text, the ledger's slice key."""
        return self.d.strftime("%Y%m%d")

    @property
    def partid(self) -> str:
        """``yyyyMM`` month partition of history tables."""
        return self.d.strftime("%Y%m")

    @property
    def year_start(self) -> dt.date:
        return self.d.replace(month=1, day=1)

    @property
    def month_start(self) -> dt.date:
        return self.d.replace(day=1)

    @property
    def month_end(self) -> dt.date:
        return self.d.replace(day=calendar.monthrange(self.d.year, self.d.month)[1])

    @property
    def prior_month(self) -> dt.date:
        """``add_months(D, -1)``: the prior-period slice date."""
        return _add_months(self.d, -1)

    def add_months(self, months: int) -> dt.date:
        return _add_months(self.d, months)

    def lit(self) -> Column:
        return F.lit(self.d)

    def __str__(self) -> str:  # pragma: no cover - convenience
        return self.d.isoformat()
