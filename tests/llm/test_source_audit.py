"""The source audit and its pointer sort against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from lendgrid.llm import byte_words, source_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n string, term string, item string, value string, p string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, *["x"] * 6) for i, (t, lang, source) in enumerate(rows)], SCHEMA)


def f(p, q):
    return (p - q) ** 2 // (p + q)


def brute(rows, least_docs, top):
    def terms(text):
        return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]

    holders, counts, groups = Counter(), defaultdict(Counter), set()
    for text, lang, source in rows:
        group = (lang or "", source or "")
        groups.add(group)
        counts[group].update(terms(text))
        holders.update((group[0], w) for w in set(terms(text)))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [w for (of, w), n in holders.items() if of == lang and n >= least_docs]
        own = {s: counts[lang, s] for of, s in groups if of == lang}
        total = sum(own.values(), Counter())

        def p(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 2) // (n + 2 * len(kept)) for w in kept}

        ps, q = {s: p(c) for s, c in own.items()}, p(total)
        for s in own:
            pairs = [(o, sum(f(ps[s][w], ps[o][w]) for w in kept)) for o in own if o != s]
            far = [(w, f(ps[s][w], q[w])) for w in kept if own[s][w] and ps[s][w] > q[w]]
            for part, items, most in (("pair", pairs, None), ("term", far, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(items[:most], 1)}
    return out


def corpus(seed, n=160, sources=7):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices(["a", "b", "é", "日", "ZZ", "th"], k=r.choice([1, 2, 3, 5, 9]))) for _ in range(60)]
    rows = []
    for _ in range(n):
        source = f"s{min(r.randrange(sources), r.randrange(sources))}"
        words = [vocabulary[min(r.randrange(60), r.randrange(60)) if r.random() < 0.8 else int(source[1:])] for _ in range(r.choice([0, 1, 5, 40]))]
        rows.append((r.choice([" ", ", ", "1", "\x00"]).join(w.upper() if r.random() < 0.1 else w for w in words), r.choice(["en", "fr"]), source))
    return rows + [(None, None, None), ("", "", ""), ("only words of a rare language", "xx", "s1"), (None, "xx", "s2"), rows[0], rows[0], ("a" * 3000 + " b", "en", "ß"), ("a " * 9000, "en", "s1")]


@pytest.mark.parametrize(("seed", "least_docs", "top"), [(1, 10, 10), (2, 1, 3), (3, 500, 2)])
def test_audit_equals_brute_force(spark, monkeypatch, seed, least_docs, top):
    monkeypatch.setattr(source_audit, "PIECE_ROWS", 5)
    rows = corpus(seed)
    got = source_audit.audit(frame(spark, rows).repartition(3), least_docs=least_docs, top=top).collect()
    assert len(got) == len(set(got))
    assert set(map(tuple, got)) == brute(rows, least_docs, top)


def test_terms_over_small_batches_and_a_table_without_rows(spark):
    rows = corpus(4, sources=30)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        got = source_audit.audit(frame(spark, rows), least_docs=2, top=4).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert set(map(tuple, got)) == brute(rows, 2, 4)
    assert source_audit.audit(frame(spark, rows[:1]).filter("doc_id > 9")).count() == 0


def test_probabilities_beyond_64_bits(spark):
    cases = [(0, 1), (5, 7), (10**12, 3 * 10**12 + 1), (9 * 10**14, 9 * 10**14 + 7), (1, 9 * 10**15)]
    rows = spark.createDataFrame(cases, "n long, total long").selectExpr("n", "total", f"{source_audit.probability('n', 'total')} AS p")
    assert {(r.n, r.total): r.p for r in rows.collect()} == {(n, t): 1 + 10**9 * (n + 2) // t for n, t in cases}


def test_pointer_sort_equals_sorted(monkeypatch):
    r = random.Random(1)
    for _ in range(60):
        monkeypatch.setattr(byte_words, "SMALL", r.choice([3, 50, 1 << 15]))
        words = ["".join(r.choices("abé日", k=r.choice([1, 2, 3, 8, 9, 16, 17, 30]))) for _ in range(r.randint(1, 60))]
        texts = [" ".join(r.choices(words, k=r.randint(0, 80))).encode() for _ in range(r.randint(1, 9))]
        buffer, _ = byte_words.joined(pa.array(texts, pa.binary()), source_audit.TERM_BYTES, b"\0")
        starts, lengths = byte_words.spans(buffer != 0)
        found = [bytes(buffer[a : a + n]) for a, n in zip(starts, lengths)]
        assert found == [w for t in texts for w in t.split()]
        order, new = byte_words.sort_pointers(buffer, starts, lengths)
        want = sorted(range(len(found)), key=lambda i: (found[i], i))
        assert order.tolist() == want
        assert new.tolist() == [i == 0 or found[want[i]] != found[want[i - 1]] for i in range(len(found))]
        assert [w.encode() for w in byte_words.strings(buffer, starts, lengths).to_pylist()] == found
        assert len(set(byte_words.hashes(buffer, starts, lengths).tolist())) == len(set(found))


def test_row_slices_hold_every_row_once():
    texts = pa.array([b"x" * n for n in (0, 5, 50, 0, 3, 100, 1)], pa.binary())
    for most in (1, 10, 60, 1000):
        assert [i for a, b in byte_words.row_slices(texts, most) for i in range(a, b)] == list(range(len(texts)))
    assert list(byte_words.row_slices(texts[:0])) == []
