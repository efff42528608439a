"""Key-checked lookups and code maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_unique(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    values: Sequence[str],
    strict: bool = True,
    name: str = "lookup",
) -> DataFrame:
    """Left join a value lookup whose key must be unique (a correlated scalar
    subquery: 0 matches -> NULL, 1 -> value, 2+ -> error).

    In ``strict`` mode the right side is reduced to one row per key with a
    partial/final aggregate that also counts rows, and a duplicated key raises
    at run time inside the plan (no driver collect), mirroring
    ``SCALAR_SUBQUERY_TOO_MANY_ROWS``. The aggregate's hash partitioning on the
    key is reused by the join, so the check adds no extra shuffle. With
    ``strict=False`` it is the plain left join of the source SQL, where a
    duplicated key multiplies the left row.
    """
    pairs = list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]
    rkeys = [r for _, r in pairs]
    if strict:
        agg = right.groupBy(*rkeys).agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.first(v, ignorenulls=False).alias(v) for v in values],
        )
    else:
        agg = right.select(*dict.fromkeys([*rkeys, *values]))
    if all(l == r for l, r in pairs):
        out = left.join(agg, on=[l for l, _ in pairs], how="left")
    else:
        ren = agg.select(*[F.col(r).alias(f"__k{i}") for i, (_, r) in enumerate(pairs)],
                         *[c for c in agg.columns if c not in rkeys])
        cond = None
        for i, (l, _) in enumerate(pairs):
            c = left[l] == ren[f"__k{i}"]
            cond = c if cond is None else cond & c
        out = left.join(ren, cond, "left").drop(*[f"__k{i}" for i in range(len(pairs))])
    if not strict:
        return out
    # only keys that are actually looked up can fail, as with a scalar subquery
    msg = f"{name}: more than one row for a lookup key"
    checked = []
    for c in out.columns:
        if c == "__n":
            continue
        if c in values:
            checked.append(F.when(F.col("__n") > 1, F.raise_error(F.lit(msg)).cast(right.schema[c].dataType))
                           .otherwise(F.col(c)).alias(c))
        else:
            checked.append(F.col(c))
    return out.select(*checked)


def code_map(
    df: DataFrame,
    col: Column | str,
    mapping: DataFrame,
    dict_code: str,
    out: str,
    default: Column | str | None = None,
) -> DataFrame:
    """Translate ``col`` through a code table ``(dict_code, ori_values,
    new_values)`` by a left join, whose strategy Spark picks from the table's
    size. Missing codes get ``default``."""
    m = mapping.where(F.col("dict_code") == F.lit(dict_code)).select(
        F.col("ori_values").alias("__ori"), F.col("new_values").alias("__new"))
    key = F.col(col) if isinstance(col, str) else col
    j = df.join(m, key == F.col("__ori"), "left")
    dflt = None if default is None else (F.col(default) if isinstance(default, str) else default)
    val = F.col("__new") if dflt is None else F.coalesce(F.col("__new"), dflt)
    return j.withColumn(out, val).drop("__ori", "__new")


def code_values(mapping: DataFrame, dict_code: str, prefix: str) -> DataFrame:
    """One dictionary of a code table as a look-up frame (``{prefix}_key``,
    ``{prefix}_new_values``) for ``attach_many``."""
    return mapping.where(F.col("dict_code") == F.lit(dict_code)).select(
        F.col("ori_values").alias(f"{prefix}_key"), F.col("new_values").alias(f"{prefix}_new_values"))


def coalesce_lookup(
    df: DataFrame,
    key: str,
    sources: Sequence[tuple[DataFrame, str, str]],
    out: str,
) -> DataFrame:
    """Look ``key`` up in several registries in priority order, first hit wins.
    ``sources`` is ``[(frame, frame_key, frame_value), ...]``; each is a left
    join on a unique key."""
    cur = df
    hits = []
    for i, (src, k, v) in enumerate(sources):
        alias = f"__hit{i}"
        s = src.select(F.col(k).alias(f"__key{i}"), F.col(v).alias(alias))
        cur = cur.join(s, F.col(key) == F.col(f"__key{i}"), "left").drop(f"__key{i}")
        hits.append(alias)
    return cur.withColumn(out, F.coalesce(*[F.col(h) for h in hits])).drop(*hits)
