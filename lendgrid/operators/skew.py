"""Left join that keeps NULL keys and heavy keys out of the shuffle.

In a left join over a wide chain many rows have no key (their chain ended earlier),
and a few keys can hold a large share of the rest. Hashed by key, each such group is
one task. ``split_left_join`` takes the rows apart first: rows without a key need no
join, rows of heavy keys meet their few right rows by a broadcast of checked size, and
the rest, which has no heavy key left, is joined as usual.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it holds more than this share of the rows that have a key.
HEAVY_SHARE = 0.02
#: Right rows that are broadcast at most; heavy keys with more of them stay in the shuffle.
MOST_BROADCAST = 20_000
KEY = "__split_key"


def heavy_keys(key: Column, df: DataFrame, share: float = HEAVY_SHARE) -> dict[int, int]:
    """The values of ``key`` (a long) that hold more than ``share`` of the rows where it is
    not NULL, with their estimated number: one pass of a mergeable frequent-items sketch, of
    which at most 1 / share values come back."""
    most = max(1, round(1 / share))
    # Eight times as many items are tracked as can be heavy, so a heavy one is never lost.
    row = df.select(key.alias(KEY)).where(F.col(KEY).isNotNull()).agg(
        F.expr(f"approx_top_k({KEY}, {most}, {8 * most})").alias("top"), F.count("*").alias("n")).first()
    return {r["item"]: r["count"] for r in row["top"] or [] if r["count"] > share * row["n"]}


@dataclass(frozen=True)
class SplitJoin:
    """The parts of a left join; ``whole`` is their union."""

    without_key: DataFrame
    heavy: DataFrame
    rest: DataFrame
    heavy_keys: tuple[int, ...]

    def whole(self) -> DataFrame:
        return self.without_key.unionByName(self.heavy).unionByName(self.rest)


def split_left_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], share: float = HEAVY_SHARE, most_broadcast: int = MOST_BROADCAST) -> SplitJoin:
    """``left`` left-joined with ``right`` on left column = right column, in parts.

    ``left`` is read once for the sketch and once for each part, so give a table or a
    checkpoint. Key columns of both sides have the same types. The result is that of the
    plain left join whatever counts as heavy: both sides are split by the same hash of the key. The
    number of right rows of each heavy key is counted, and keys are broadcast, the smallest first, as
    long as ``most_broadcast`` rows are not passed; the others stay in the shuffle, where adaptive
    execution may split them.
    """
    for ours, theirs in on.items():
        if left.schema[ours].dataType != right.schema[theirs].dataType:
            raise TypeError(f"{ours} and {theirs} have different types; cast one of them")
    if clash := set(left.columns) & set(right.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    def key(columns) -> Column:
        known = F.lit(True)
        for c in columns:
            known = known & F.col(c).isNotNull()
        return F.when(known, F.xxhash64(*columns))

    def joined(a: DataFrame, b: DataFrame) -> DataFrame:
        same = F.lit(True)
        for ours, theirs in on.items():
            same = same & (F.col(ours) == F.col(theirs))
        return a.join(b, same, "left")

    ours, theirs = key(on.keys()), key(on.values())
    found = sorted(heavy_keys(ours, left, share))
    if found:
        sizes = {k: 0 for k in found} | {r[KEY]: r["count"] for r in right.select(theirs.alias(KEY)).where(F.col(KEY).isin(found)).groupBy(KEY).count().collect()}
        taken = 0
        for k in sorted(sizes, key=sizes.get):
            taken += sizes[k]
            if taken > most_broadcast:
                found.remove(k)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    without = left.where(ours.isNull()).select("*", *nothing)
    among = ours.isin(found) if found else F.lit(False)
    heavy = joined(left.where(ours.isNotNull() & among), F.broadcast(right.where(theirs.isin(found) if found else F.lit(False))))
    rest = joined(left.where(ours.isNotNull() & ~among), right.where(theirs.isNotNull() & ~theirs.isin(found)) if found else right.where(theirs.isNotNull()))
    return SplitJoin(without, heavy, rest, tuple(found))
