"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir), calls one operator of ``lendgrid.llm`` on
all rows its predecessor kept, and returns the columns of documents (the last one
the packed pieces). Results are written as Parquet in the shared folder and read
again by the next stage.

Null values, empty and very long texts, repeated rows, empty tables and further
columns are handled as the operators' docstrings say; further columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendgrid.llm import bestfit_pack, decontaminate, kneser_ney, simhash_vptree, suffix_dedup
from lendgrid.llm.common import cut, read_table
from lendgrid.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney models of trusted text accept."""
    return kneser_ney.keep_accepted(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 3-word shingles, at most 2 bits apart."""
    return simhash_vptree.keep_one_of_each(docs, shingle=3, max_bits=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that lie in a 100-byte string with an earlier
    start; n_chars follows the text."""
    rows = suffix_dedup.remove_repeats(docs, length=100, as_text=True)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens."""
    return bestfit_pack.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: No SQL: the models, fingerprints and packing cannot be written in it; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; returns the packed pieces."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
