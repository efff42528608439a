"""Slice writes and the run log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def replace_slice(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Idempotently replace the partitions present in ``df`` (DELETE slice +
    INSERT): dynamic partition overwrite rewrites only the slices being
    written and leaves every other date untouched. The write commits through
    Spark's output committer, so lost executors only retry tasks."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols)
       .parquet(path))


def clear_slice(spark: SparkSession, path: str, schema: T.StructType, **equals: str) -> None:
    """Empty one slice (DELETE without an INSERT): its partition folder is
    overwritten with a file of no rows; no other slice is touched."""
    folder = path.rstrip("/") + "".join(f"/{col}={value}" for col, value in equals.items())
    rest = T.StructType([f for f in schema.fields if f.name not in equals])
    spark.createDataFrame([], rest).coalesce(1).write.mode("overwrite").parquet(folder)


def stored_slice(spark: SparkSession, path: str, schema: T.StructType, **equals: str) -> DataFrame | None:
    """``read_slice``, or None where nothing was ever written to ``path``."""
    try:
        return read_slice(spark, path, schema, **equals)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_slice(spark: SparkSession, path: str, schema: T.StructType, **equals: str) -> DataFrame:
    """Read slices back with an explicit schema (partition values such as
    ``20240131`` would otherwise be inferred as integers)."""
    df = spark.read.schema(schema).parquet(path)
    for col, value in equals.items():
        df = df.where(F.col(col) == F.lit(value))
    return df


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store rows dealt into ``buckets`` by ``keys`` and sorted within them, as a catalog table at
    ``path``, and read them back. Two tables written with the same keys and buckets are joined
    on these keys as they lie, without a shuffle."""
    spark = df.sparkSession
    # dealt before the write, so that a bucket is one sorted file and not one a task
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table))
    return spark.table(table)


RUN_LOG_SCHEMA = T.StructType([
    T.StructField("data_date", T.StringType()),
    T.StructField("procedure", T.StringType()),
    T.StructField("step_id", T.IntegerType()),
    T.StructField("step_desc", T.StringType()),
    T.StructField("step_flag", T.IntegerType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("logged_at", T.TimestampType()),
])


#: The log's description column holds this many characters of an error text.
DESC_CHARS = 280


class RunLog:
    """Step log of one run: start (0), done (1) and error (-1) events with the
    rows affected. Row counts come from ``Observation`` metrics collected while
    the data is written, so counting costs no extra pass over the data."""

    def __init__(self, data_date: str, procedure: str, spark: SparkSession | None = None, path: str | None = None):
        """With ``path``, every row is appended to the log there as it is made, so
        that a run whose driver dies leaves the steps it began."""
        self.data_date = data_date
        self.procedure = procedure
        self.spark = spark
        self.path = path
        self.rows: list[tuple] = []

    def observe(self, df: DataFrame, step: str, counts: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
        """``df`` with an observation of ``counts`` (by default of all ``rows``)."""
        obs = Observation(step)
        counts = {"rows": F.count(F.lit(1))} if counts is None else counts
        return df.observe(obs, *[c.alias(name) for name, c in counts.items()]), obs

    def log(self, step_id: int, desc: str, flag: int, rows: int = 0) -> None:
        self.rows.append((self.data_date, self.procedure, step_id, desc[:DESC_CHARS], flag, int(rows),
                          dt.datetime.now()))
        if self.path:
            self.spark.createDataFrame(self.rows[-1:], RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, RUN_LOG_SCHEMA)
