"""Membership flags: IN-subquery values, id-set unions, HAVING filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exists_flag(df: DataFrame, key: str, ids: DataFrame, id_col: str, out: str,
                yes: str = "Y", no: str = "N") -> DataFrame:
    """``CASE WHEN key IN (SELECT id ...) THEN yes ELSE no END``.

    The id set is de-duplicated (partial aggregate, so a repeated id costs one
    row per map task) and left-joined; NULL keys never match."""
    s = ids.select(F.col(id_col).alias("__id")).where(F.col("__id").isNotNull()).distinct()
    j = df.join(s, F.col(key) == F.col("__id"), "left")
    return j.withColumn(out, F.when(F.col("__id").isNotNull(), F.lit(yes)).otherwise(F.lit(no))).drop("__id")


def membership_flag(df: DataFrame, key: str, id_sets: Sequence[DataFrame], out: str,
                    yes: str = "Y", no: str = "N") -> DataFrame:
    """Flag membership in the UNION of several one-column id sets. The union
    is built once and de-duplicated once."""
    first, *rest = [s.toDF("__id") for s in id_sets]
    u = first
    for s in rest:
        u = u.unionByName(s)
    return exists_flag(df, key, u, "__id", out, yes, no)


def having_multi(df: DataFrame, keys: Sequence[str], min_count: int = 2,
                 count_col: str = "n") -> DataFrame:
    """``GROUP BY keys HAVING COUNT(*) >= min_count``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) >= min_count)
