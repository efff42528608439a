"""Line deduplication against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrid.llm import line_dedup

SCHEMA = "doc_id long, text string, lang string, n_lines string, n_dropped string, keep int, h1 string, place string, open string, word string"
NO_ID = -(1 << 63)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "x", 1, "x", "x", "x", "x") for i, t in rows], SCHEMA)


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)


def brute(rows, least_chars, least_docs):
    """(doc_id, n_lines, n_dropped, kept) of every row."""
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(NO_ID if i is None else i)
    lost = {k: max(ids) for k, ids in holders.items() if len(ids) >= least_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in lost or lost[key(x)] == (NO_ID if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept).encode()))
    return Counter(out)


def got(docs, **how):
    rows = line_dedup.kept_texts(docs, line_dedup.keep_bitmaps(docs, **how)).collect()
    return Counter((r.doc_id, r.n_lines, r.n_dropped, bytes(r.kept)) for r in rows)


def corpus(seed=5, n=300):
    r = random.Random(seed)
    common = [f"Common line number {i} of the corpus" for i in range(6)] + ["ÄÖÜ é ß 日本語 " * 2, "short", "", "x" * 19, "y" * 20]
    rows = []
    for i in range(n):
        lines = [r.choice([f"own {r.random()} line of the text", r.choice(common), "  " + r.choice(common).upper() + "\t", common[0], "\x0b" + common[1] + "\r"]) for _ in range(r.randint(0, 9))]
        rows.append((r.randrange(-n, 4 * n), "\n".join(lines)))
    return rows + [(None, common[0]), (None, common[2] + "\n" + common[2]), (7, None), (8, ""), (8, "\n\n"), rows[0], rows[0], (rows[0][0], "another text\n" + common[0])]


@pytest.mark.parametrize(("least_chars", "least_docs"), [(20, 3), (1, 2), (0, 1), (5, 40)])
def test_line_dedup_equals_brute_force(spark, least_chars, least_docs):
    rows = corpus()
    docs = frame(spark, rows).repartition(5)
    assert got(docs, least_chars=least_chars, least_docs=least_docs) == brute(rows, least_chars, least_docs)


def test_a_line_over_many_ranges(spark):
    """One line in every document fills most ranges; small Arrow batches end inside runs."""
    rows = [(i, f"the line that every document holds\nown line of document {i % 90}\n" * (1 + i % 3)) for i in range(400)]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        docs = frame(spark, rows)
        assert got(docs) == brute(rows, 20, 3)
        hashed = line_dedup.line_rows(docs, 20).filter("h1 is not null")
        sizes = hashed.repartitionByRange("h1", "h2", F.desc("doc_id"), "place").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 400
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_a_very_long_text_and_a_table_without_rows(spark):
    long = "\n".join(f"line {i % 50_000} of a very long text" for i in range(120_000))
    rows = [(1, long), (2, "line 7 of a very long text"), (3, "line 7 of a very long text\nline 9 of a very long text"), (4, "LINE 9 of a very long text ")]
    assert got(frame(spark, rows)) == brute(rows, 20, 3)
    assert not got(frame(spark, rows).filter("doc_id > 9"))


def test_keep_bitmaps_round_trip():
    for n in (1, 8, 9, 1000):
        keep = np.random.default_rng(n).random(n) < 0.7
        assert (line_dedup.decode_keep(line_dedup.encode_keep(keep), n) == keep).all()
