"""Latest / first row per key.

``latest_by`` is the ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY o) = 1``
shape. Spark plans it as Sort -> WindowGroupLimit(Partial) -> Exchange ->
WindowGroupLimit(Final) -> Window, so every map task keeps only its top rows
per key before the shuffle: a key holding a third of all rows sends at most
``keep`` rows per map task across the network.

Ties are nondeterministic in SQL; every caller passes a full tie-break list
so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs: Sequence[Column | str]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    keep: int = 1,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first ``keep`` rows per ``keys`` under ``order`` (a list of
    sort expressions such as ``F.col('d').desc()``). ``rank_col`` keeps the
    rank as a column (for callers that filter it in a later join)."""
    name = rank_col or "__rn"
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= keep)
    return out if rank_col else out.drop(name)


def top1_by_max(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Rows whose ``measure`` equals the per-key maximum (the correlated
    ``x = (SELECT MAX(x) ...)`` shape): a partial/final aggregate joined back
    on ``keys + measure``. Keeps all tied rows, like the SQL."""
    mx = df.groupBy(*keys).agg(F.max(measure).alias(measure))
    return df.join(mx, on=[*keys, measure], how="inner")


def first_flag(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    row_key: Sequence[str],
    flag: str,
    yes: str = "Y",
    no: str = "N",
    match_group: bool = True,
) -> DataFrame:
    """Flag the first row per ``group`` under ascending ``order`` without
    putting a whole group into one task.

    The first row per group is found with the skew-safe top-1 plan above
    (``row_key`` completes the tie-break) and joined back on near-unique keys,
    so the join has no hot partition: ``group + row_key`` by default, with
    NULL group values matching each other (they form one group, as in
    ``PARTITION BY``); with ``match_group=False`` on ``row_key`` alone,
    with plain equality (an update matched on the row key). Every input row
    is kept.
    """
    extra = [k for k in row_key if k not in order]
    firsts = latest_by(df.select(*group, *order, *extra), group,
                       [F.col(c).asc_nulls_last() for c in [*order, *extra]])
    match = list(dict.fromkeys([*group, *row_key] if match_group else row_key))
    marks = firsts.select(*[F.col(k).alias(f"__m_{k}") for k in match], F.lit(True).alias("__hit"))
    cond = None
    for k in match:
        if match_group and k in group:
            eq = F.col(k).eqNullSafe(F.col(f"__m_{k}"))
        else:
            eq = F.col(k) == F.col(f"__m_{k}")
        cond = eq if cond is None else cond & eq
    out = df.join(marks, cond, "left")
    flagged = F.when(F.col("__hit"), F.lit(yes)).otherwise(F.lit(no))
    return out.withColumn(flag, flagged).drop("__hit", *[f"__m_{k}" for k in match])


def first_last_aggs(order: Sequence[str], payload: Sequence[str], first: str | None = "first",
                    last: str | None = "last") -> list[Column]:
    """Aggregate expressions giving, per group, the payload of the first row
    under ascending ``order`` and of the last row (the first under descending
    order), NULLs ordered last both ways -- the ``ROW_NUMBER() = 1`` rows --
    as ``min`` / ``max`` of a struct.

    Used inside one ``groupBy().agg()`` this reads the data once and
    aggregates map-side (a hot key collapses before the shuffle), where
    two windows would sort and shuffle every row twice. Each order field is
    preceded by its NULL indicator so NULLs sort after values for ``min``;
    ``max`` already treats NULL fields as smallest.
    """
    out = []
    if first:
        fields = []
        for c in order:
            fields += [F.col(c).isNull().alias(f"__n_{c}"), F.col(c).alias(f"__o_{c}")]
        out.append(F.min(F.struct(*fields, *[F.col(p).alias(p) for p in payload])).alias(first))
    if last:
        fields = [F.col(c).alias(f"__o_{c}") for c in order]
        out.append(F.max(F.struct(*fields, *[F.col(p).alias(p) for p in payload])).alias(last))
    return out
