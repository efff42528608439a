"""Table-driven code classification.

Long ``CASE`` ladders are expressed as Python mappings and compiled into one
``CASE WHEN`` expression, keeping the mapping data separate from the logic.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c: Column | str, mapping: Mapping[object, object], default: object = None) -> Column:
    """``DECODE(c, k1, v1, k2, v2, ..., default)``: first equal key wins,
    NULL input matches only a NULL key; unlisted values yield ``default``."""
    c = _col(c)
    expr = None
    for k, v in mapping.items():
        cond = c.isNull() if k is None else (c == F.lit(k))
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def case_map(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered ``(condition, value)`` rules -> ``CASE WHEN``; values may be
    literals or columns."""
    expr = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def prefix_map(c: Column | str, rules: Sequence[tuple[Iterable[str], object]], default: object = None) -> Column:
    """Classify by string prefix: the first rule having a matching prefix wins."""
    c = _col(c)
    compiled = []
    for prefixes, value in rules:
        cond = None
        for p in prefixes:
            one = c.startswith(p)
            cond = one if cond is None else (cond | one)
        compiled.append((cond, value))
    return case_map(compiled, default)


def in_code_set(c: Column | str, codes: Iterable[str]) -> Column:
    """Membership in a literal code list (``IN (...)``). Three-valued: a NULL
    input yields NULL, like SQL."""
    return _col(c).isin(list(codes))
