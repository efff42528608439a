"""String helpers with the source system's conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def substr1(c: Column | str, length: int, pos: int = 1) -> Column:
    """1-based substring; position 0 in the source SQL means 1."""
    return F.substring(_col(c), max(pos, 1), length)


def concat_null_as_empty(*parts: Column | str) -> Column:
    """Concatenate treating NULL parts as empty text (address, remarks)."""
    return F.concat_ws("", *[_col(p) for p in parts])


def text_after(c: Column | str, marker: str) -> Column:
    """Text after the first ``marker`` (the whole text when it is absent);
    an empty remainder becomes NULL."""
    c = _col(c)
    tail = F.substr(c, F.instr(c, marker) + F.lit(1))
    return F.when(F.length(tail) == 0, F.lit(None).cast("string")).otherwise(tail)


def rate_text(c: Column | str, scale: int = 5) -> Column:
    """Decimal rendered with a fixed number of places (HALF_UP), as text."""
    return _col(c).cast(f"decimal(24,{scale})").cast("string")
