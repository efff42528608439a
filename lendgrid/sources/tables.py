"""Catalogue of input tables stored as one Parquet dataset per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``Tables(spark, root).read('orders', 'o_orderkey', ...)`` reads
    ``{root}/orders.parquet``; naming the columns keeps the scan's
    ``ReadSchema`` to what the query uses (Catalyst prunes further)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._loaded: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def read(self, name: str, *columns: str) -> DataFrame:
        """The table as a lazy frame. The loaded frame (file listing and
        footer schema) is kept per catalogue, so repeated reads of the same
        immutable dataset skip schema discovery; no data is cached."""
        df = self._loaded.get(name)
        if df is None:
            df = self._loaded[name] = self.spark.read.parquet(self.path(name))
        return df.select(*columns) if columns else df
