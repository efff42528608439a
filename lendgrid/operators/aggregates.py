"""Pre-aggregate-then-join and string collection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def agg_join(left: DataFrame, detail: DataFrame, keys: Sequence[str], aggs: Sequence[Column],
             how: str = "left") -> DataFrame:
    """Aggregate ``detail`` per ``keys`` (partial aggregation map-side, so hot
    keys collapse before the shuffle) and join the result to ``left``."""
    return left.join(detail.groupBy(*keys).agg(*aggs), on=list(keys), how=how)


def collect_concat(df: DataFrame, keys: Sequence[str], value: Column | str, sep: str, out: str,
                   chunk_prefix: int = 3) -> DataFrame:
    """Sorted, ``sep``-joined list of the text values per key
    (``CONCAT_WS(sep, COLLECT_LIST(v))`` with a defined order).

    For keys of bounded size (the vouchers of an application): values are first
    joined per ``(key, first chunk_prefix characters)``, and these chunks, in order,
    per key. Values with a common start are one chunk, so a key with very many
    of them is sorted in one task; ``ordered_concat`` is for such keys.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("string")
    chunks = (df.select(*keys, v.alias("__v")).where(F.col("__v").isNotNull())
              .withColumn("__p", F.substring("__v", 1, chunk_prefix))
              .groupBy(*keys, "__p")
              .agg(F.array_join(F.array_sort(F.collect_list("__v")), sep).alias("__chunk")))
    return chunks.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__p", "__chunk"))),
                                 lambda s: s["__chunk"]), sep).alias(out))


def ordered_concat(df: DataFrame, keys: Sequence[str], value: Column | str, sep: str, out: str) -> DataFrame:
    """``collect_concat`` for keys with any number of values: the same sorted,
    ``sep``-joined list.

    All rows are range-partitioned by key and value (and, among equal values, by row), so a hot
    key lies in as many ranges as it fills. A range is a piece of its keys' lists; pieces are
    sorted and joined each by itself, and a key's pieces are joined by their number. Until
    that last step, whose output is one text a key, no task holds more of a key than a range.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("string")
    ranged = (df.select(*keys, v.alias("__v")).where(F.col("__v").isNotNull()).withColumn("__row", F.monotonically_increasing_id())
              .repartitionByRange(*keys, "__v", "__row").withColumn("__piece", F.spark_partition_id()))
    pieces = ranged.groupBy(*keys, "__piece").agg(F.array_join(F.array_sort(F.collect_list("__v")), sep).alias("__text"))
    numbered = F.array_sort(F.collect_list(F.struct("__piece", "__text")))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(numbered, lambda s: s["__text"]), sep).alias(out))
