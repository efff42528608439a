"""The pipeline: planted cases are caught, clean documents stay, and every stage
takes what its predecessor kept."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lendgrid.llm.common import DOCUMENT_COLUMNS, cut
from lendgrid.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES) and corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "best-fit packing"]


def corpus():
    r = random.Random(21)
    syllables = ["the", "an", "re", "er", "on", "in", "ed", "nd", "ha", "at", "es", "or", "ti", "st"]
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    passage = " ".join(word() for _ in range(60))
    item = " ".join(word() for _ in range(30))
    clean = [" ".join(word() for _ in range(150)) for _ in range(160)]
    rows = [(i if i < 60 else 1000 + i, t) for i, t in enumerate(clean)]
    rows += [(100, clean[3]), (101, clean[3].replace(" ", "  ", 5)), (110, clean[0][:400] + " " + passage + " " + " ".join(word() for _ in range(100))),
             (111, " ".join(word() for _ in range(100)) + " " + passage + " " + " ".join(word() for _ in range(80))),
             (120, " ".join(word() for _ in range(60)) + " " + item + " " + " ".join(word() for _ in range(60))),
             (130, " ".join(word() if j % 15 else "qwxzkv" for j in range(150))), (140, None), (141, "")]
    return rows, passage, item


def test_stages_on_planted_cases(spark, tmp_path):
    rows, passage, item = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in [*range(50), *range(1060, 1160)]] + [(130, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, texts = {}, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, str(tmp_path)), "t")
        assert docs.columns == DOCUMENT_COLUMNS
        found = docs.collect()
        kept[name], texts[name] = {x.doc_id for x in found}, {x.doc_id: x.text for x in found}
        assert len(found) == len(kept[name])
    first, second, third, fourth = (kept[n] for n, _ in corpus_pipeline.STAGES[:-1])
    assert 130 not in first and len({*range(60)} - first) <= 2 and {3, 100, 101, 110, 111, 120, 140, 141} <= first
    assert not {100, 101, 141} & second and {3, 140} <= second and first - second <= {100, 101, 141}
    assert third == second and passage in texts["suffix-array dedup"][110] and passage not in texts["suffix-array dedup"][111]
    assert third - fourth == {120}
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {x.doc_id for x in pieces.select("doc_id").distinct().collect()} == fourth
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 2048


@pytest.mark.parametrize("name", ["op1_html_extract", "op3_token_counts", "op4_kneser_ney", "op8_quality_rules", "op9_simhash", "op10_token_store"])
def test_queries_return_every_row(spark, name):
    table = "pages" if name.startswith("op1_") else "documents"
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
