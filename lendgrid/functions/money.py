"""Money and rate arithmetic in exact decimals (sums do not depend on order)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(12,6)"
TOTAL = "decimal(38,2)"
RATE_PART = "decimal(12,8)"
EXACT_RATE = "decimal(30,16)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def money_sum(c: Column | str) -> Column:
    """Sum of money amounts with an explicit result type (the widest
    2-place decimal), independent of the input column's precision."""
    return F.sum(_col(c)).cast(TOTAL)


def rate(c: Column | str) -> Column:
    return _col(c).cast(RATE)


def effective_rate(base: Column | str, spread: Column | str, adj_pct: Column | str) -> Column:
    """Executed rate ``(base + spread) * (1 + adj/100)``, exact; NULL where a part is NULL."""
    b, s = _col(base).cast(RATE_PART), _col(spread).cast(RATE_PART)
    a = _col(adj_pct).cast(RATE)
    return ((b + s) * (F.lit(1) + a * F.lit(Decimal("0.01")))).cast(EXACT_RATE)
