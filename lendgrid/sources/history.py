"""History ("zipper") tables and dated reads.

A history table holds half-open validity rows ``[begndt, overdt)`` and a
month partition ``partid`` (``yyyyMM``). The row active on ``D`` satisfies
``begndt <= D AND overdt > D AND partid = yyyyMM(D)``. All three predicates
are literals, so Parquet prunes the ``partid`` directory and pushes both
date bounds into the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendgrid.functions import date_lit, text_date_between
from lendgrid.rundate import RunDate

OPEN_END = dt.date(9999, 12, 31)


def as_of(df: DataFrame, run: RunDate, begin: str = "begndt", end: str = "overdt",
          part: str | None = "partid") -> DataFrame:
    """Rows of a history table active on the run date."""
    cond = (F.col(begin) <= F.lit(run.d)) & (F.col(end) > F.lit(run.d))
    if part:
        cond = cond & (F.col(part) == F.lit(run.partid))
    return df.where(cond)


def partition_only(df: DataFrame, run: RunDate, part: str = "partid") -> DataFrame:
    """Month partition of the run date, without the validity filter."""
    return df.where(F.col(part) == F.lit(run.partid))


def event_window(df: DataFrame, col: Column | str, start: dt.date, end: dt.date,
                 raw_ts: str | None = None) -> DataFrame:
    """Rows whose event date lies in ``[start, end]`` (year-to-date,
    month-to-date, ``BETWEEN trunc(D,'YYYY') AND last_day(D)``).

    When the date is derived from a stored timestamp (``to_date(ts)``), pass
    the raw column as ``raw_ts``: the equivalent range on the raw column is
    added so the bounds reach the Parquet scan (row-group skipping); the
    derived-date predicate stays, so the result is unchanged."""
    c = F.col(col) if isinstance(col, str) else col
    out = df.where(c.between(F.lit(start), F.lit(end)))
    if raw_ts:
        lo = F.lit(start).cast("timestamp_ntz")        # date literals: no time zone involved
        hi = F.lit(end + dt.timedelta(days=1)).cast("timestamp_ntz")
        out = out.where((F.col(raw_ts) >= lo) & (F.col(raw_ts) < hi))
    return out


def dated_dim(df: DataFrame, run: RunDate, col: str = "data_date") -> DataFrame:
    """Dimension stored per business date as ``yyyyMMdd`` text."""
    return df.where(F.col(col) == F.lit(run.d8))


def history_from_events(events: DataFrame, key: str, ts: str, order_tiebreak: str,
                        payload: list[str]) -> DataFrame:
    """Derive a half-open history table from a change log.

    Each change opens a row on its day (``begndt``) that lasts until the day
    of the key's next change (``overdt``, open end ``9999-12-31``); several
    changes on one day leave zero-length rows for all but the last, so at most
    one row per key is active on any date.

    Skew-safe: the ``lead`` window runs over one row per (key, day) -- a
    pre-aggregate, so a key with a third of all changes still contributes at
    most one row per calendar day -- and the per-day results are joined back
    to the changes on ``(key, day)``.
    """
    ev = events.select(key, ts, order_tiebreak, *payload).withColumn("begndt", F.to_date(ts))
    days = ev.groupBy(key, "begndt").agg(F.max(F.struct(F.col(ts), F.col(order_tiebreak))).alias("__last"))
    w = Window.partitionBy(key).orderBy("begndt")
    days = days.withColumn("__next_day", F.lead("begndt").over(w))
    out = ev.join(days, on=[key, "begndt"], how="inner")
    is_last = (F.col("__last")[ts] == F.col(ts)) & (F.col("__last")[order_tiebreak] == F.col(order_tiebreak))
    overdt = F.when(is_last, F.coalesce(F.col("__next_day"), F.lit(OPEN_END))).otherwise(F.col("begndt"))
    return out.select(
        key, ts, order_tiebreak, *payload, "begndt", overdt.alias("overdt"),
        F.date_format("begndt", "yyyyMM").alias("partid"),
    )


def date_window(df: DataFrame, column: str, low: dt.date | None, high: dt.date | None) -> DataFrame:
    """Rows whose date lies within the bounds (inclusive, None is open), whether the column is
    a DATE or text of mixed layouts; either way the bounds reach the scan."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.where(text_date_between(column, low, high))
    day = F.col(column).cast("date")
    df = df if low is None else df.where(day >= date_lit(low))
    return df if high is None else df.where(day <= date_lit(high))


def as_of_dates(df: DataFrame, dates: Sequence[dt.date], begin: str = "begndt", end: str = "overdt", part: str | None = "partid", out: str = "as_of_dt") -> DataFrame:
    """The rows of a history table active on each of several dates, in one scan: ``as_of``
    for all of them, with the date in ``out``.

    Rows meet the dates by month, so a row is compared with the dates of the months it covers
    and not with all. With ``part`` that is its own partition's month, and the scan reads these
    partitions alone; without, a row is dealt to every asked month within its validity. The list of
    dates is given by the caller, so the side that Spark may broadcast has its size.
    """
    spark = df.sparkSession
    if not dates:
        return df.withColumn(out, F.lit(None).cast("date")).where(F.lit(False))
    asked = spark.createDataFrame([(d, f"{d:%Y%m}") for d in sorted(set(dates))], f"`{out}` date, __month string")
    first, last, months = min(dates), max(dates), sorted({f"{d:%Y%m}" for d in dates})
    rows = df.where((F.col(begin) <= F.lit(last)) & (F.col(end) > F.lit(first)))
    if part:
        rows = rows.where(F.col(part).isin(months)).withColumn("__of", F.col(part))
    else:
        low, high = F.greatest(F.col(begin), F.lit(first)), F.least(F.date_sub(end, 1), F.lit(last))
        covered = F.when(low <= high, F.sequence(F.trunc(low, "month"), F.trunc(high, "month"), F.expr("interval 1 month")))
        rows = rows.withColumn("__day", F.explode(covered)).withColumn("__of", F.date_format("__day", "yyyyMM")).drop("__day").where(F.col("__of").isin(months))
    active = (F.col("__of") == F.col("__month")) & (F.col(begin) <= F.col(out)) & (F.col(end) > F.col(out))
    return rows.join(asked, active).drop("__of", "__month")
