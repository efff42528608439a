"""Date normalisation and date arithmetic.

Source systems encode dates as ``yyyyMMdd``, ``yyyy-MM-dd`` and ``yyyy/MM/dd``
text, with ``''``, ``'null'`` and invalid days meaning "no date". ``norm_date``
turns every encoding into a DATE (NULL on failure) so comparisons never hit
ANSI cast errors.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text date layouts found in the source systems, tried in order.
DATE_PATTERNS = ("yyyyMMdd", "yyyy-MM-dd", "yyyy/MM/dd")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_date(c: Column | str) -> Column:
    """Text in any known layout (or a DATE/TIMESTAMP) -> DATE, NULL when
    empty/invalid. A text timestamp is read by its date part (before a space
    or ``T``); years outside 1-9999 are treated as invalid."""
    s = F.trim(_col(c).cast("string"))
    day = F.substring_index(F.substring_index(s, " ", 1), "T", 1)
    parsed = F.coalesce(*[F.try_to_date(day, p) for p in DATE_PATTERNS])
    return F.when(F.year(parsed).between(1, 9999), parsed)


def date_texts(d: dt.date) -> tuple[str, ...]:
    """A date in each known layout."""
    return tuple(p.replace("yyyy", f"{d.year:04d}").replace("MM", f"{d.month:02d}").replace("dd", f"{d.day:02d}") for p in DATE_PATTERNS)


def text_date_between(c: Column | str, low: dt.date | None, high: dt.date | None) -> Column:
    """``norm_date(c) BETWEEN low AND high`` of a text column, with bounds that reach the scan.

    A function of the column hides it from the scan's statistics. Each layout sorts as its
    dates do, with whatever follows the day, so the dates of a window lie in one range of raw
    text a layout; texts with spaces before them are one range more. A row group outside all of
    them is skipped, and the exact test decides about the rest. Bounds are inclusive, None is open.
    """
    c = _col(c)
    after = None if high is None or high == dt.date.max else date_texts(high + dt.timedelta(days=1))
    raw = (c >= F.lit(" ")) & (c < F.lit("!"))
    for i in range(len(DATE_PATTERNS)):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (c >= F.lit(date_texts(low)[i]))
        if after is not None:
            inside = inside & (c < F.lit(after[i]))
        raw = raw | inside
    day, bounds = norm_date(c), [None if d is None else date_lit(d) for d in (low, high)]
    if low is None and high is None:
        exact = day.isNotNull()
    elif high is None:
        exact = day >= bounds[0]
    else:
        exact = day <= bounds[1] if low is None else day.between(*bounds)
    return raw & exact


def date_lit(d: dt.date) -> Column:
    """A date of any year as a literal."""
    return F.lit(f"{d.year:04d}-{d.month:02d}-{d.day:02d}").cast("date")


def _lit_date(d: dt.date | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d)


def overdue_days(run_date: dt.date | Column, *since: Column | str, plus_one: bool = True) -> Column:
    """Days overdue measured from the earliest unpaid date(s) up to ``D``.

    Each candidate contributes ``datediff(D, since_i)`` (+1 when the convention
    counts the due day itself); NULL candidates contribute 0 and the result is
    the largest contribution, so a loan with no overdue dates gets 0.
    """
    d = _lit_date(run_date)
    extra = 1 if plus_one else 0
    parts = [
        F.when(_col(s).isNotNull(), F.datediff(d, _col(s)) + F.lit(extra)).otherwise(F.lit(0))
        for s in since
    ]
    return parts[0] if len(parts) == 1 else F.greatest(*parts)


def term_months(start: Column | str, end: Column | str) -> Column:
    """Whole months of a term, rounding partial months up:
    ``ceil(months_between(end, start))``."""
    return F.ceil(F.months_between(_col(end), _col(start))).cast("int")


def coalesce_dates(*candidates: Column | str) -> Column:
    return F.coalesce(*[_col(c) for c in candidates])
