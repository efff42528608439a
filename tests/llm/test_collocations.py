"""Phrase mining against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lendgrid.llm import byte_words, collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, k string, n string, shard string, rank string, key string, a string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, *["x"] * 7) for i, (t, lang) in enumerate(rows)], SCHEMA)


def pieces(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def brute(rows, least, longest, share, top):
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for words in pieces(text):
            n[lang] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = set()
    for lang, own in counts.items():
        often = {p: c for p, c in own.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in often.items():
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * c >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in often.items()):
                found.append((score, a, " ".join(p), own[p[:k]], own[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out |= {(lang, i, phrase, a, l, r, n[lang], score) for i, (score, a, phrase, l, r) in enumerate(found[:top], 1)}
    return out


def corpus(seed, n=250):
    r = random.Random(seed)
    words = ["the", "of", "Of", "a", "ß", "日本", "long-word-of-more-bytes", "x" * 20, "b", "c"]
    fixed = ["in spite of the", "as well as", "A B C d", "one two"]
    rows = []
    for _ in range(n):
        parts = [r.choice(fixed) if r.random() < 0.3 else r.choice(words) for _ in range(r.randint(0, 25))]
        rows.append(("".join(p + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\r"]) for p in parts), r.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(None, None), ("", "en"), ("the the the the the", "en"), rows[0], rows[0], ("as well as " * 4000, "fr"), ("z" * 5000 + " of the", "en")]


@pytest.mark.parametrize(("seed", "least", "longest", "share", "top", "shards"), [(1, 30, 4, 80, 2000, 2), (2, 10, 4, 50, 7, 3), (3, 3, 5, 80, 2000, 1), (4, 5, 2, 80, 2000, 5), (5, 20, 4, 80, 2000, 4)])
def test_collocations_equal_brute_force(spark, seed, least, longest, share, top, shards):
    rows = corpus(seed)
    got = collocations.collocations(frame(spark, rows).repartition(3), least=least, longest=longest, share=share, top=top, shards=shards).collect()
    assert len(got) == len(set(got))
    assert set(map(tuple, got)) == brute(rows, least, longest, share, top)


def test_filters_that_are_full_cost_only_time(spark, monkeypatch):
    """With 64 bits a length nearly everything is a false hit; the result is the same."""
    monkeypatch.setattr(collocations, "BLOOM_BITS", 64)
    rows = corpus(6, n=120)
    got = collocations.collocations(frame(spark, rows), least=12, shards=3).collect()
    assert set(map(tuple, got)) == brute(rows, 12, 4, 80, 2000)


def test_small_slices_and_a_table_without_rows(spark, monkeypatch):
    rows = corpus(7, n=60)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
        got = collocations.collocations(frame(spark, rows), least=6).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert set(map(tuple, got)) == brute(rows, 6, 4, 80, 2000)
    assert collocations.collocations(frame(spark, rows).filter("doc_id > 999")).count() == 0


def test_a_phrase_is_counted_once_in_every_shard():
    """Whatever the filters hold now and before, what is counted now was not active before."""
    r = np.random.default_rng(3)
    texts = [(" ".join(r.choice(["a", "b", "c", "d"], 30)) + ".").encode() for _ in range(20)]
    words = collocations.Words(pa.array(texts, pa.binary()), ["en"] * 20)
    for _ in range(20):
        keys = np.unique(words.keys)
        before, now = collocations.Filters(4), collocations.Filters(4)
        before.bits[:] = r.integers(0, 256, before.bits.shape, np.uint8) & r.integers(0, 256, before.bits.shape, np.uint8)
        now.bits[:] = before.bits | r.integers(0, 256, before.bits.shape, np.uint8)
        was = {k: set(a.tolist()) for k, a, _, _ in collocations.active_phrases(words, before, None, 4)}
        for k, at, _, old in collocations.active_phrases(words, now, before, 4):
            assert set(at[old].tolist()) == was[k] and len(keys) == 4


def test_words_and_pieces():
    texts = ["One  two\tthree. four,five", "", "é É", "a b c"]
    words = collocations.Words(pa.array([t.encode() for t in texts], pa.binary()), ["x"] * 4)
    spelled = [bytes(words.buffer[a : a + n]).decode() for a, n in zip(words.starts, words.lengths)]
    assert spelled == ["one", "two", "three", "four", "five", "é", "É", "a", "b", "c"]
    assert words.follows.tolist() == [True, True, False, False, False, True, False, True, True, False] and words.n_words.tolist() == [5, 0, 2, 3]
    assert words.phrases(np.array([0, 7]), 3).to_pylist() == ["one two three", "a b c"]
    assert byte_words.strings(words.buffer, words.starts[:0], words.lengths[:0], 2).to_pylist() == []
