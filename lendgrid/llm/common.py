"""Helpers shared by the training-data operators: table reading and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendgrid.operators.attach import CLEANUP
from lendgrid.session import ensure_checkpoint_dir

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share
    (``spark.checkpoint.dir``; only a local session without one gets its own)."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The written table ends the lineage, so a lost executor costs a reread and
    never the work above. The explicit schema keeps empty tables readable. With
    ``free`` the writing job's shuffle files go with it, so that they do not lie on
    the disk beside those of the next.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    kept = spark.conf.get(CLEANUP, None)
    if free:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.set(CLEANUP, kept) if kept else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application: they import it
    by name, so that what a module keeps (a loaded vocabulary) lasts over tasks."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    top = Path(__file__).resolve().parent.parent
    made = Path(tempfile.mkdtemp(prefix="lendgrid-")) / "lendgrid.zip"
    with zipfile.ZipFile(made, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f"{top.name}/{f.relative_to(top)}")
    spark.sparkContext.addPyFile(str(made))
    _shipped.add(application)


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns most operators read, a null text being the empty one."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
