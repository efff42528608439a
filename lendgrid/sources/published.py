"""Slices that are published together, and row marks that are updated in place.

A publication is staged first: the rows of its slices go into a folder of their
own, which no reader looks at. One append of a single file to the manifest then names,
for every slice of the publication, the folder that holds it from now on. Before
that append readers see the old slices, after it the new ones, and never a mixture;
a run that dies leaves a folder that nothing refers to. An emptied slice is a
manifest row without a folder.

    path/rows/version=<id>/<slice columns>/...     rows as staged
    path/updates/version=<id>/<slice columns>/...  marks of stored rows that changed since
    path/manifest/...                              one row a publication and slice

A store can have one mark column, which is derived from other slices too (the first
loan of a customer over all source systems). Rows keep their own value beside
the derived one, so the mark can be taken back. When another slice changes some marks,
only the keys of those rows are written, into the updates; reading lays them over the
rows, and ``compact`` writes them into the rows.

All files are written by Spark's committer. One publication at a time may write a slice.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Joins the values of a slice's columns to one text; no slice is named with it.
MARK_SEP = "\x1f"
ROWS, UPDATES = "rows", "updates"


@dataclass(frozen=True)
class Mark:
    """``column`` shows ``value`` on marked rows and their own value on others; rows are
    found again by the slice columns and ``key``."""

    column: str
    value: str
    key: tuple[str, ...]

    @property
    def derived(self) -> str:
        """The stored column that says whether a row is marked."""
        return f"derived_{self.column}"


class PublishedSlices:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, slice_columns: Sequence[str], mark: Mark | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.slice_columns = list(slice_columns)
        self.mark = mark
        self.columns = [f.name for f in schema.fields]
        marks = [T.StructField(mark.derived, T.BooleanType())] if mark else []
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + marks)
        key = [schema[c] for c in (mark.key if mark else ())]
        self._update_schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in key if f.name not in self.slice_columns] + marks
                                           + [schema[c] for c in self.slice_columns])
        self._manifest_schema = T.StructType([T.StructField("kind", T.StringType()), *[T.StructField(c, T.StringType()) for c in self.slice_columns],
                                              T.StructField("version", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("n_rows", T.LongType())])

    # --- the manifest

    def manifest(self) -> DataFrame | None:
        """One row a publication and slice, or None where nothing was ever published."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.schema(self._manifest_schema).parquet(f"{self.path}/manifest")

    def _entries(self, equals: Mapping[str, str]) -> list[T.Row]:
        """The manifest rows that count: of every slice the last of its rows and the updates
        after it. Their number is that of slices and of publications since they were compacted."""
        manifest = self.manifest()
        if manifest is None:
            return []
        for column, value in equals.items():
            manifest = manifest.where(F.col(column) == F.lit(str(value)))
        last = manifest.where(F.col("kind") == ROWS).groupBy(*self.slice_columns).agg(F.max("seq").alias("last"))
        live = manifest.join(last, self.slice_columns).where(((F.col("kind") == ROWS) & (F.col("seq") == F.col("last"))) | ((F.col("kind") == UPDATES) & (F.col("seq") > F.col("last"))))
        return live.where(F.col("version").isNotNull()).select("kind", "version", "seq", *self.slice_columns).collect()

    def _read(self, kind: str, schema: T.StructType, entries: Iterable[T.Row]) -> DataFrame:
        """The staged rows of the entries, with the ``seq`` of their publication; other folders are pruned."""
        entries = [e for e in entries if e["kind"] == kind]
        if not entries:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("seq", T.LongType())]))
        root = f"{self.path}/{kind}"
        versions = sorted({e["version"] for e in entries})
        staged = (self.spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())])).option("basePath", root)
                  .parquet(*[f"{root}/version={v}" for v in versions]))
        names = ["version", *self.slice_columns]
        listed = [MARK_SEP.join(str(e[c]) for c in names) for e in entries]
        rows = staged.where(F.concat_ws(MARK_SEP, *[F.col(c).cast("string") for c in names]).isin(listed))
        seqs = {e["version"]: e["seq"] for e in entries}
        seq = F.lit(None).cast("long")
        if len(seqs) == 1:
            seq = F.lit(next(iter(seqs.values())))
        else:
            seq = F.create_map(*[F.lit(x) for pair in seqs.items() for x in pair])[F.col("version")]
        return rows.withColumn("seq", seq.cast("long")).drop("version")

    # --- reading

    def read_marked(self, **equals: str) -> DataFrame:
        """The published rows with their own values, and with ``Mark.derived`` as it is now."""
        entries = self._entries(equals)
        rows = self._read(ROWS, self.schema, entries)
        if self.mark and any(e["kind"] == UPDATES for e in entries):
            key = [*dict.fromkeys([*self.slice_columns, *self.mark.key])]
            # Of several updates of a row the last one counts, if it came after the row.
            updates = (self._read(UPDATES, self._update_schema, entries).groupBy(*key)
                       .agg(F.max(F.struct("seq", self.mark.derived)).alias("u"))
                       .select(*[F.col(c).alias(f"u_{c}") for c in key], F.col("u.seq").alias("u_seq"), F.col(f"u.{self.mark.derived}").alias("u_mark")))
            same = F.col("u_seq") > F.col("seq")
            for c in key:
                same = same & (F.col(c) == F.col(f"u_{c}"))
            rows = rows.join(updates, same, "left").withColumn(self.mark.derived, F.coalesce("u_mark", self.mark.derived))
        for column, value in equals.items():
            rows = rows.where(F.col(column) == F.lit(value))
        return rows.select(*self.schema.names)

    def read(self, **equals: str) -> DataFrame:
        """The published rows of the slices whose columns have the given values."""
        return self.shown(self.read_marked(**equals))

    def shown(self, rows: DataFrame) -> DataFrame:
        """Rows with the mark column as readers see it."""
        if not self.mark:
            return rows.select(*self.columns)
        value = F.when(F.col(self.mark.derived), F.lit(self.mark.value)).otherwise(F.col(self.mark.column))
        return rows.select(*[value.alias(c) if c == self.mark.column else F.col(c) for c in self.columns])

    # --- writing

    def stage(self, rows: DataFrame, kind: str = ROWS) -> str:
        """Write rows into a folder of their own, which no reader sees until ``publish`` names
        it; returns its version."""
        schema = self.schema if kind == ROWS else self._update_schema
        version = uuid.uuid4().hex
        (rows.select(*schema.names).write.partitionBy(*self.slice_columns).parquet(f"{self.path}/{kind}/version={version}"))
        return version

    def publish(self, slices: Mapping[tuple, int], version: str, updates: Mapping[tuple, int] | None = None, updates_version: str | None = None) -> None:
        """Show the staged rows: ``slices`` names every slice of the publication with its number of
        rows (0 empties it), ``updates`` the slices of which marks changed. One file is appended."""
        manifest = self.manifest()
        seq = 1 + (0 if manifest is None else manifest.agg(F.max("seq")).first()[0] or 0)
        rows = [(ROWS, *map(str, key), version if n else None, seq, n) for key, n in slices.items()]
        rows += [(UPDATES, *map(str, key), updates_version, seq, n) for key, n in (updates or {}).items() if n]
        if rows:
            self.spark.createDataFrame(rows, self._manifest_schema).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def staged_counts(self, version: str, kind: str = ROWS) -> dict[tuple, int]:
        """The number of rows staged for each slice."""
        schema = self.schema if kind == ROWS else self._update_schema
        staged = self.spark.read.schema(schema).parquet(f"{self.path}/{kind}/version={version}")
        return {tuple(str(r[c]) for c in self.slice_columns): r["count"] for r in staged.groupBy(*self.slice_columns).count().collect()}

    def compact(self, **equals: str) -> int:
        """Write the updates into the rows of their slices; returns how many slices were rewritten."""
        entries = self._entries(equals)
        slices = sorted({tuple(e[c] for c in self.slice_columns) for e in entries if e["kind"] == UPDATES})
        if not slices:
            return 0
        listed = [MARK_SEP.join(key) for key in slices]
        rows = self.read_marked(**equals).where(F.concat_ws(MARK_SEP, *[F.col(c).cast("string") for c in self.slice_columns]).isin(listed))
        version = self.stage(rows)
        counts = self.staged_counts(version)
        self.publish({key: counts.get(key, 0) for key in slices}, version)
        return len(slices)
