"""Verdicts of the quality rules against brute force, and their independence of the order of rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lendgrid.llm import quality_rules
from lendgrid.llm.quality_rules import GROWTH, LEAST_VALUE, PRIOR_DOCS, RATIOS, REACH, ZERO_BIN

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words string, kept string, ratio string, bin string, n_docs string, windows string"


def base(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    chars, symbols = sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or "")
    n = max(1, len(words))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return failed, {"mean_word_chars": chars / n, "symbol_ratio": symbols / max(1, chars), "dup_line_ratio": (len(lines) - len(set(lines))) / max(1, len(lines)), "repeat_word_ratio": len(repeated) / n}


def sketch_fences(values):
    """(low, high) of each ratio, from the bins of all documents' values."""
    out = {}
    for ratio, (least, _) in RATIOS.items():
        bins = sorted(ZERO_BIN if v[ratio] < LEAST_VALUE else math.ceil(math.log(v[ratio]) / math.log(GROWTH)) for v in values)
        low, center, high = (0.0 if b == ZERO_BIN else 2 * GROWTH**b / (GROWTH + 1) for p in (0.25, 0.5, 0.75) for b in [bins[max(0, math.ceil(p * len(bins)) - 1)]])
        reach = REACH * max(high - low, least)
        out[ratio] = (center - reach, center + reach)
    return out


def brute(rows):
    groups, langs, judged = defaultdict(list), defaultdict(list), []
    for i, text, lang, source in rows:
        failed, ratios = base(text)
        key = (lang or "", source or "")
        judged.append((i, key, failed, ratios))
        if not failed:
            groups[key].append(ratios)
            langs[key[0]].append(ratios)
    of_group, of_lang = {k: sketch_fences(v) for k, v in groups.items()}, {k: sketch_fences(v) for k, v in langs.items()}
    out = {}
    for i, key, failed, ratios in judged:
        kept = not failed
        if kept:
            n = len(groups[key])
            for ratio, (_, both) in RATIOS.items():
                low, high = ((n * of_group[key][ratio][s] + PRIOR_DOCS * of_lang[key[0]][ratio][s]) / (n + PRIOR_DOCS) for s in (0, 1))
                kept &= ratios[ratio] <= high and (not both or ratios[ratio] >= low)
        out[i] = (failed, kept)
    return out


def corpus():
    r, rows = random.Random(12), []
    for i in range(420):
        kind, lang, source = r.random(), r.choice(["en", "en", "de", None]), r.choice(["a", "b", "c", None, ""])
        length = (2, 6) if lang == "de" else (1, 4)
        if kind < 0.05:
            length = (14, 20)
        words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(*length))) for _ in range(r.choice([40, 60, 90, 200]))]
        if 0.05 < kind < 0.1:
            words = [w + r.choice(["##", "$$$", "|<>"]) for w in words]
        lines = [" ".join(words[k : k + 9]) for k in range(0, len(words), 9)]
        if 0.1 < kind < 0.2:
            lines += r.choices(lines, k=r.choice([1, len(lines), 3 * len(lines)]))
        rows.append((i, "\n".join(lines), lang, source))
    return rows + [(1000, None, "en", "a"), (1001, "", "en", "a"), (1002, "word " * 60, "xx", "alone"), (1003, " ".join(f"w{k}" for k in range(60)), "xx", "alone")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA)


def test_verdicts_equal_brute_force(spark):
    rows = corpus()
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.quality_rules(frame(spark, rows)).collect()}
    want = brute(rows)
    assert got == want
    assert len({v for v in want.values()}) == 3 and sum(not failed and not kept for failed, kept in want.values()) >= 15


def test_fences_do_not_depend_on_the_order_of_rows(spark):
    rows = quality_rules.with_ratios(quality_rules.base_counts(spark.range(200_000, numPartitions=5).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.col("id") % 3 + 1), lambda i: F.substring(F.sha2(F.concat(F.col("id"), i), 256), F.lit(1), (F.col("id") % 11 + 1).cast("int")))).alias("text"),
        F.lit("en").alias("lang"), F.lit("one").alias("source"))))
    found = [quality_rules.fences(x).collect() for x in (rows, rows.repartition(13), rows.orderBy(F.desc("doc_id")))]
    assert found[0] == found[1] == found[2] and len(found[0]) == 1
