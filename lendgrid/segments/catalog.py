"""Where a segment finds its input tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendgrid.rundate import RunDate
from lendgrid.sources import as_of


@dataclass(frozen=True)
class Choices:
    """What a deployment sets for its segments.

    ``org_rewrites`` maps names of organisations to the names to show instead,
    ``org_names`` organisation numbers to names. ``literal`` names points where the old job
    is to be followed to the letter, for reconciling with it: ``Q3`` (micro-loan income
    reads its history with the bounds the wrong way round, so it is empty) and ``Q4`` (personal loans'
    yearly interest income stands in the monthly column).
    """

    org_rewrites: Mapping[str, str] = field(default_factory=dict)
    org_names: Mapping[str, str] = field(default_factory=dict)
    literal: frozenset[str] = frozenset()

    def __post_init__(self):
        if unknown := set(self.literal) - {"Q3", "Q4"}:
            raise ValueError(f"no such literal reading: {sorted(unknown)}")


class Catalog:
    """Resolves logical table names (``OMI.NL_ACCT_LOAN_HS``) to DataFrames.

    ``Catalog.tables(spark)`` reads catalog tables, ``Catalog.parquet(spark,
    root)`` reads ``{root}/{name}`` Parquet datasets partitioned by
    ``partid``, and ``Catalog.frames({...})`` wraps prepared frames (tests).
    Names are case-insensitive. A catalog also carries the deployment's
    ``choices``, and ``key_checks`` gathers what the segments observe about
    duplicate keys of their look-ups.
    """

    def __init__(self, resolve: Callable[[str], DataFrame], choices: Choices | None = None):
        self._resolve = resolve
        self.choices = choices or Choices()
        self.key_checks: list = []

    @classmethod
    def tables(cls, spark: SparkSession) -> "Catalog":
        return cls(lambda name: spark.table(name))

    @classmethod
    def parquet(cls, spark: SparkSession, root: str) -> "Catalog":
        root = root.rstrip("/")
        return cls(lambda name: spark.read.parquet(f"{root}/{name.lower()}"))

    @classmethod
    def frames(cls, frames: Mapping[str, DataFrame]) -> "Catalog":
        by_name = {k.lower(): v for k, v in frames.items()}
        return cls(lambda name: by_name[name.lower()])

    def with_tables(self, frames: Mapping[str, DataFrame]) -> "Catalog":
        """A catalog in which ``frames`` replace (or add) the named tables."""
        by_name = {k.lower(): v for k, v in frames.items()}
        return Catalog(lambda name: by_name[name.lower()] if name.lower() in by_name else self._resolve(name), self.choices)

    def with_choices(self, choices: Choices) -> "Catalog":
        return Catalog(self._resolve, choices)

    def read(self, name: str) -> DataFrame:
        """The table with lower-case column names."""
        df = self._resolve(name)
        return df.select(*[F.col(c).alias(c.lower()) for c in df.columns])

    def snapshot(self, name: str, run: RunDate) -> DataFrame:
        """Rows of a history table active on the run date."""
        return as_of(self.read(name), run)
