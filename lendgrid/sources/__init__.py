"""Reads and writes: history (as-of) reads, event windows, dated dimensions,
derived history tables, date-slice replacement and the run log."""

from lendgrid.sources.history import (
    OPEN_END,
    as_of,
    as_of_dates,
    date_window,
    dated_dim,
    event_window,
    history_from_events,
    partition_only,
)
from lendgrid.sources.published import Mark, PublishedSlices
from lendgrid.sources.sinks import RunLog, clear_slice, read_slice, replace_slice, stored_slice, write_bucketed
from lendgrid.sources.tables import Tables

__all__ = [
    "OPEN_END",
    "Mark",
    "PublishedSlices",
    "RunLog",
    "Tables",
    "as_of",
    "as_of_dates",
    "date_window",
    "dated_dim",
    "event_window",
    "history_from_events",
    "partition_only",
    "read_slice",
    "clear_slice",
    "replace_slice",
    "stored_slice",
    "write_bucketed",
]
