"""Every operator against a brute-force version on small tables, with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrid.llm import (bestfit_pack, decontaminate, elias_fano, html_extract, kneser_ney, license_scan, quality_rules, simhash_vptree, suffix_dedup,
                          token_counts, token_store, tokenizers)
from lendgrid.llm.common import CLEANUP, cut
from lendgrid.llm.queries import tokenizer_path

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Of documents, with further columns that are called like columns the operators make.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, row int, n_bytes string, kept string, key int, start string"


def frame(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, (langs or {}).get(i, "en"), "s", None if t is None else len(t), "x", 1, "x", "x", 1, "x") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def sample(seed=1, n=40, letters="abcdefgh", most=60):
    r = random.Random(seed)
    return [" ".join("".join(r.choices(letters, k=r.randint(1, 6))) for _ in range(r.randint(0, most))) for _ in range(n)]


ODD = [None, "", " ", "\n\t\n", "a", "a b", "é ß 日本 ﬁ\x00", "<|endoftext|> x", "x" * 5000, "the cat " * 3000, "a\r\nb c", " two  spaces ", "▁a▁", "it's 12,345!!"]
ODD_IDS = [None, 3, 3, *range(5, 5 + len(ODD) - 3)]


# --- 3, 10: tokens

@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_token_counts_equal_the_library(spark, chunk):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ODD + sample()
    got = token_counts.count_tokens(frame(spark, texts + texts[:3], [*range(len(texts)), 0, 1, 2]), path, limit=100, chunk=chunk).collect()
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 100)
                   for i, t in zip([*range(len(texts)), 0, 1, 2], texts + texts[:3]))
    assert Counter(map(tuple, got)) == want


def test_prefix_scan_composes_like_a_loop():
    t = token_counts.load(tokenizer_path("piece_bpe_32k.model"))
    text = "  the quick  brown fox " * 9
    maps = [t.chunk_map(text[i : i + 5]) for i in range(0, len(text), 5)]
    loop = [maps[0]]
    for m in maps[1:]:
        loop.append(t.compose(loop[-1], m))
    assert t.scan(maps) == loop


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_fast_ids_equal_the_library(name):
    r = random.Random(2)
    pool = [" ", "  ", "the", "ing", "\n", "\t", "é", "İ", "ß", "日本", "<|endoftext|>", "'s", "12", "!!", "\xa0", "\x85", "***", "A", "ⅷ", "word", "\r"]
    coder = tokenizers.load(tokenizer_path(name))
    for text in [t or "" for t in ODD] + ["".join(r.choices(pool, k=r.randint(0, 30))) for _ in range(1500)]:
        assert coder.ids(text) == coder.by_library(text), text


def test_elias_fano_round_trip():
    r = random.Random(3)
    for values in ([], [0], [0, 0, 0], [5], [2**40], sorted(r.randrange(10**6) for _ in range(3000)), sorted(r.randrange(2**50) for _ in range(1500))):
        code = elias_fano.EliasFano(b"??" + elias_fano.encode(values), 2)
        assert list(code.all()) == values and [code[i] for i in range(0, len(values), 7)] == values[::7]
        assert code.size == len(elias_fano.encode(values))
    n, top = 100_000, 2**31
    values = sorted(r.randrange(top) for _ in range(n))
    assert 8 * len(elias_fano.encode(values)) < n * (2 + 15 + 0.2)  # 2 + log2(top / n) and the samples


@pytest.mark.parametrize("shard_ids", [1 << 21, 50])
def test_token_store_round_trip(spark, tmp_path, shard_ids):
    path, texts = tokenizer_path("word_bpe_49k.json"), ODD + sample() + ["same", "same"]
    ids = [*range(len(ODD)), *range(100, 140), 7, 7]
    coder = tokenizers.load(path)
    out = str(tmp_path / f"store{shard_ids}")
    token_store.write_store(frame(spark, texts, ids), out, path, end_id=2, shard_ids=shard_ids)
    want, at = [], 0
    for i, t in sorted(zip(ids, [t or "" for t in texts])):
        own = coder.by_library(t) + (2).to_bytes(4, "little")
        want.append((i, at, len(own) // 4, zlib.crc32(own)))
        at += len(own) // 4
    got = token_store.read_store(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    one = token_store.documents_tokens(spark, out, [4, 5]).collect()
    assert {r.doc_id: r.tokens for r in one} == {i: list(np.frombuffer(coder.by_library(texts[i]) + (2).to_bytes(4, "little"), "<u4")) for i in (4, 5)}


def test_token_store_null_ids_and_empty_table(spark, tmp_path):
    path = tokenizer_path("word_bpe_49k.json")
    token_store.write_store(frame(spark, ["b", "a", "c"], [None, None, -4]), str(tmp_path / "n"), path, end_id=2)
    got = sorted(map(tuple, token_store.read_store(spark, str(tmp_path / "n")).select("doc_id", "start", "n_tokens").collect()), key=lambda x: x[1])
    assert got == [(None, 0, 2), (None, 2, 2), (-4, 4, 2)]
    token_store.write_store(frame(spark, ["b"]).filter("doc_id < 0"), str(tmp_path / "e"), path, end_id=2)
    assert token_store.read_store(spark, str(tmp_path / "e")).count() == 0


# --- 7: packing

def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {bins[k]: k for k in range(len(bins)) if bins[k] + items[i] <= capacity}.values():
            bins[k] += items[i]
            place(i + 1, bins)
            bins[k] -= items[i]
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def test_dominance_reduction_keeps_the_optimum():
    r = random.Random(4)
    for _ in range(400):
        capacity = r.choice([10, 20, 50])
        items = [r.randint(1, capacity) for _ in range(r.randint(0, 8))]
        fixed, rest = bestfit_pack.reduce_dominated(dict(Counter(items)), capacity)
        assert sum(n for _, n in fixed) + optimum(list(Counter(rest).elements()), capacity) == optimum(items, capacity), items
        patterns, _ = bestfit_pack.plan(dict(Counter(items)), capacity)
        used = Counter()
        for pattern, n in patterns:
            assert sum(pattern) <= capacity
            used.update({k: n * v for k, v in Counter(pattern).items()})
        assert used == Counter(items)


def test_pack_is_gapless_and_exact(spark):
    path, capacity = tokenizer_path("byte_bpe_50k.json"), 16
    texts, ids = ODD + sample() + ["same text", "same text"], [*range(len(ODD)), *range(100, 140), 7, 7]
    coder = tokenizers.load(path)
    rows = bestfit_pack.pack(frame(spark, texts, ids), path, end_id=0, capacity=capacity).collect()
    whole = Counter()
    for i, t in zip(ids, texts):
        own = coder.by_library(t or "") + bytes(4)
        n = len(own) // 4
        first = n % capacity or capacity
        cuts = [0, *range(first, n + 1, capacity)]
        whole.update((i, k, a, b - a, zlib.crc32(own[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == whole
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert bestfit_pack.pack(frame(spark, ["a"]).filter("doc_id < 0"), path, 0, capacity).count() == 0


# --- 9: SimHash

def brute_components(texts, ids, shingle=3, bits=2):
    from xxhash import xxh64_intdigest

    fps = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        shingles = [b" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
        votes = [0] * 64
        for s in shingles:
            h = xxh64_intdigest(s, 42)
            for b in range(64):
                votes[b] += h >> b & 1
        fps.append(sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles)))
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: min((i for i, x in zip(ids, group) if x == g and i is not None), default=None) for g in group}
    return Counter((i, f"{fp:016x}", least[g]) for i, fp, g in zip(ids, fps, group))


def test_simhash_components(spark):
    r = random.Random(5)
    base = sample(6, 30, most=120)
    near = [" ".join(w if r.random() > 0.01 else "zz" for w in t.split()) for t in base for _ in range(3)]
    texts = ODD + base + near + base[:5]
    ids = [None, 900, 900, *range(3, len(texts))]
    got = simhash_vptree.simhash_components(frame(spark, texts, ids), 3, 2).collect()
    assert Counter((x.doc_id, f"{x.fp & (1 << 64) - 1:016x}", x.component_id) for x in got) == brute_components(texts, ids)
    kept = simhash_vptree.keep_one_of_each(frame(spark, texts, ids), 3, 2)
    want = brute_components(texts, ids)
    assert Counter(x.doc_id for x in kept.collect()) == Counter({c for _, _, c in want}) and kept.columns == frame(spark, []).columns
    empty = frame(spark, ["a"]).filter("doc_id < 0")
    assert simhash_vptree.simhash_components(empty, 3, 2).count() == 0


@pytest.mark.parametrize("bits", [1, 2, 4])
def test_tree_search_finds_every_link(bits):
    r = np.random.default_rng(7)
    base = r.integers(0, 1 << 63, 700, np.uint64)
    points = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << r.integers(0, 64, 700).astype(np.uint64)) for _ in range(3))]))
    tree = simhash_vptree.Tree(points[::9], 4)
    home = tree.home(points)
    rows, leaves = tree.visits(points, bits)
    met = defaultdict(set)
    for row, leaf in zip(rows.tolist(), leaves.tolist()):
        met[leaf].add(row)
    i, j = np.nonzero(np.triu(simhash_vptree.distances(points[:, None], points[None, :]) <= bits, 1))
    assert all(b in met[home[a]] or a in met[home[b]] for a, b in zip(i, j))
    forest = simhash_vptree.Forest(len(points))
    simhash_vptree.search(points, np.arange(len(points)), np.arange(len(points)), bits, forest)
    assert all(forest.find(a) == forest.find(b) for a, b in zip(i.tolist(), j.tolist()))


# --- 2: suffix deduplication

def brute_repeats(rows, length):
    seen, out = set(), []
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = True
            seen.add(s)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot,batch", [(2000, 1 << 17), (3, 64)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, hot, batch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BATCH", batch)
    r = random.Random(8)
    a = "".join(r.choice("abc é") for _ in range(600))
    texts = [a, a, a[:300], "x" * 400, None, "", "q" + a[100:420] + "zz" * 90, "ab" * 200, a[50:250] * 2 + a[300:402], "y" * 99, "y" * 100, "y" * 101, *ODD[3:]]
    texts += ["".join(r.choice("abcdefgh ") for _ in range(150)) + a[200:330] + "".join(r.choice("abcdefgh ") for _ in range(150)) for _ in range(20)]
    for length in (100, 40):
        rows = suffix_dedup.remove_repeats(frame(spark, texts), length)
        got = rows.select("doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256)).collect()
        assert sorted(map(tuple, got)) == brute_repeats(list(enumerate(texts)), length)


def test_suffix_dedup_repeated_rows_nulls_and_columns(spark):
    a = "".join(random.Random(9).choices("abcd ", k=300))
    rows = suffix_dedup.remove_repeats(frame(spark, [a, a, a, None], [4, 4, None, 1]), 100, as_text=True)
    assert rows.columns == ["doc_id", "lang", "source", "n_chars", "fp", "row", "kept", "key", "start", "n_bytes", "spans", "text"]
    got = rows.select("doc_id", "text", "n_bytes").collect()
    assert Counter((x.doc_id, x.text, x.n_bytes) for x in got) == Counter([(4, a, 300), (4, "", 300), (None, "", 300), (1, None, 0)])
    assert suffix_dedup.remove_repeats(frame(spark, [a]).filter("doc_id < 0"), 100).count() == 0


@pytest.mark.parametrize("letter", ["é", "あ", "𝄞"])
def test_cut_characters_do_not_become_others(spark, letter):
    r = random.Random(14)
    middle = "".join(r.choices("abcdefgh", k=150))
    first, other = "x" + letter + middle + letter + "y", "z" + letter + middle + letter + "w"
    got = {x.doc_id: x.text for x in suffix_dedup.remove_repeats(frame(spark, [first, other, "q" * 99]), 100, as_text=True).select("doc_id", "text").collect()}
    assert got == {0: first, 1: "zw", 2: "q" * 99}
    # Other characters with the same last byte before and the same first byte behind: what repeats begins and ends within them.
    before = next(c for c in map(chr, range(ord(letter) + 1, ord(letter) + 5000)) if len(c.encode()) == len(letter.encode()) and c.encode()[-1] == letter.encode()[-1])
    behind = chr(ord(letter) + 1)
    mixed = "z" + before + middle + behind + "w"
    got = {x.doc_id: x.text for x in suffix_dedup.remove_repeats(frame(spark, [first, mixed]), 100, as_text=True).select("doc_id", "text").collect()}
    assert got[1] == "zw"


def test_a_text_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 400)
    r = random.Random(15)
    long = "".join(r.choices("abcdef ", k=5000))
    texts = [long, "x" + long[390:620] + "y", long[4800:], "".join(r.choices("abcdef ", k=3000)) + long[1000:1300]]
    rows = suffix_dedup.remove_repeats(frame(spark, texts), 100)
    got = rows.select("doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got)) == brute_repeats(list(enumerate(texts)), 100)


def test_groups_follow_the_size_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 2000)
    texts = sample(18, 120, most=80) * 2
    rows = suffix_dedup.remove_repeats(frame(spark, texts), 100)
    got = rows.select("doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got)) == brute_repeats(list(enumerate(texts)), 100)


def test_levels_are_logarithmic():
    levels, r = suffix_dedup.Levels(), np.random.default_rng(10)
    seen = set()
    for _ in range(64):
        one = r.integers(0, 4000, 100).astype(np.uint64)
        two = one % np.uint64(3)
        want = []
        for x in zip(one.tolist(), two.tolist()):
            want.append(x in seen)
            seen.add(x)
        assert levels.add(one, two).tolist() == want
    assert len(levels.levels) <= 8


# --- 6: decontamination

def test_decontamination_equals_brute_force(spark):
    """Every item of up to 24 words laid over every document at every place, in documents long and short."""
    r = random.Random(41)
    words = ["".join(r.choices("abcdefgh", k=4)) for _ in range(900)]
    items = [[r.choice(words) for _ in range(n)] for n in [5, 5, 6, 7, 8, 9, 10, 11, 12, 14, 16, 18, 20, 22, 24]]
    docs = []
    for _ in range(120):
        text = [r.choice(words) for _ in range(r.choice([3, 10, 40, 300]))]
        for _ in range(r.choice([0, 1, 1, 2])):
            item = list(r.choice(items))
            for at in r.sample(range(len(item)), r.randint(0, len(item) // 4)):
                item[at] = r.choice(words)
            item = item[r.choice([0, 0, 0, 1]) : len(item) - r.choice([0, 0, 0, 2])]
            at = r.randint(0, len(text))
            text[at:at] = item
        docs.append(" ".join(text))
    long = [r.choice(words) for _ in range(20_000)]
    for k in range(0, 20_000, 700):
        long[k : k + 20] = items[12]
    docs.append(" ".join(long))
    bench = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.equal_words for x in decontaminate.find_overlaps(frame(spark, docs), bench).collect()}
    want = {}
    for d, text in enumerate(docs):
        own = decontaminate.word_hashes(text)
        for i, item in enumerate(items):
            of_item = decontaminate.word_hashes(" ".join(item))
            found = [decontaminate.overlap(own, of_item, k)[0] for k in range(1 - len(of_item), len(own)) if decontaminate.overlap(own, of_item, k)]
            if found:
                want[d, i] = max(found)
    assert got == want and len(want) > 60


def test_decontamination_exact_and_substituted(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choices("abcdefghijklmnop", k=r.randint(2, 7)))
    items = [" ".join(word() for _ in range(n)) for n in (5, 6, 7, 9, 15, 20, 30, 45, 60)] + ["too few words"]
    bench = spark.createDataFrame([*((i, t) for i, t in enumerate(items)), (None, None), (50, "")], "item_id long, text string")
    docs, want = [], set()
    for k, item in enumerate(items[:-1]):
        words = item.split()
        changed = [w if j % 10 != 5 else word() + "x" for j, w in enumerate(words)] if len(words) >= 15 else words
        docs.append(" ".join(word() for _ in range(40)) + " " + item.upper().replace(" ", ", ") + ". " + " ".join(word() for _ in range(10)))
        docs.append(" ".join(word() for _ in range(30)) + "\n" + " ".join(changed) + " " + " ".join(word() for _ in range(30)))
        want |= {(2 * k, k), (2 * k + 1, k)}
    clean = [" ".join(word() for _ in range(200)) for _ in range(10)]
    texts = docs + clean + [None, "", docs[0], "too few words"]
    ids = [*range(len(docs) + len(clean)), None, 777, None, 778]
    found = decontaminate.find_overlaps(frame(spark, texts, ids), bench).collect()
    assert {(x.doc_id, x.item_id) for x in found} == want | {(None, 0)}
    kept = decontaminate.remove_contaminated(frame(spark, texts, ids), bench)
    assert Counter((x.doc_id, x.text) for x in kept.collect()) == Counter([*zip(range(len(docs), len(docs) + 10), clean), (None, None), (777, ""), (778, "too few words")])
    assert kept.columns == frame(spark, []).columns
    assert decontaminate.find_overlaps(frame(spark, texts, ids), bench.filter("item_id < 0")).count() == 0
    assert decontaminate.find_overlaps(frame(spark, ["a"]).filter("doc_id < 0"), bench).count() == 0


@pytest.mark.parametrize("n", range(5, 25))
def test_masks_cover_every_substitution(n):
    fits = [{a + i for i, c in enumerate(m) if c == "1"} for m in decontaminate.masks_for(n) for a in range(n - len(m) + 1)]
    most = max(k for k in range(n) if n - k >= decontaminate.SIMILAR * n)
    for changed in itertools.combinations(range(n), most):
        assert any(places.isdisjoint(changed) for places in fits), changed


def test_decontamination_of_short_items_with_substitutions(spark):
    r = random.Random(37)
    word = lambda: "".join(r.choices("abcdefghijklmnop", k=r.randint(2, 7)))
    items = [[word() for _ in range(n)] for n in (5, 6, 7, 8, 9, 10, 11, 12, 15, 17, 20, 40)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    texts, want = [], set()
    for k, item in enumerate(items):
        most = len(item) // 5
        for changed in [*(r.sample(range(len(item)), most) for _ in range(6)), range(most, len(item), 5)[:most]]:
            want.add((len(texts), k))
            texts.append(" ".join([*(word() for _ in range(20)), *(word() + "x" if j in changed else w for j, w in enumerate(item)), *(word() for _ in range(20))]))
        # One word more differs in the middle: no overlap that counts.
        if len(item) < 12:
            texts.append(" ".join([*(word() for _ in range(20)), *(word() + "x" if j <= most else w for j, w in enumerate(item)), *(word() for _ in range(20))]))
    found = decontaminate.find_overlaps(frame(spark, texts), bench).collect()
    assert {(x.doc_id, x.item_id) for x in found} == want


# --- 5: licenses

def test_license_scan_equals_brute_force(spark):
    clean = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    texts = list(ODD) + sample(12, 40, most=200)
    r = random.Random(13)
    for k, (_, notice) in enumerate(license_scan.TEMPLATES):
        words = sample(20 + k, 1, most=80)[0].split()
        at = r.randint(0, len(words))
        texts.append(" ".join([*words[:at], notice.upper() if k % 2 else notice, *words[at:]]))
    got = {(x.doc_id, x.license_id) for x in license_scan.scan(frame(spark, texts)).collect()}
    want = set()
    for i, t in enumerate(texts):
        w = clean(t)
        have = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
        for name, notice in license_scan.TEMPLATES:
            n = clean(notice)
            need = {tuple(n[j : j + 5]) for j in range(len(n) - 4)}
            if len(need & have) >= 0.8 * len(need):
                want.add((i, name))
    assert got == want
    assert license_scan.scan(frame(spark, ["a"]).filter("doc_id < 0")).count() == 0


@pytest.mark.parametrize("most_words", [100_000, 3])
def test_license_templates_of_any_size(spark, monkeypatch, most_words):
    monkeypatch.setattr(license_scan, "MOST_TEMPLATE_WORDS", most_words)  # beyond it nothing is broadcast
    templates = [("short", "MIT License"), ("one", "copyleft!"), ("four", "All rights are reserved"), ("none", " ?! "), ("long", " ".join(f"w{i}" for i in range(40))), ("short", "the MIT licence")]
    texts = ["under the mit, LICENSE of", "mit licenses", None, "", "all rights are", "now all rights are reserved copyleft", "x " + " ".join(f"w{i}" for i in range(3, 40)) + " mit license mit license", "the mit licence"]
    got = sorted((x.doc_id, x.license_id, x.begin_word) for x in license_scan.scan(frame(spark, texts), templates).collect())
    assert [(i, name) for i, name, _ in got] == [(0, "short"), (5, "four"), (5, "one"), (6, "long"), (6, "short"), (7, "short")]
    assert {(i, name): at for i, name, at in got}[0, "short"] == 2 and {(i, name): at for i, name, at in got}[6, "short"] == 38


def test_license_bands_retrieve_what_containment_finds(spark):
    """Recall of the banding against exact containment, over texts with every fifth word of a notice changed at most once a shingle."""
    r = random.Random(31)
    texts, want = [], set()
    notices = [(name, [w for w in re.split(r"[^\w]+|_", text.lower()) if w]) for name, text in license_scan.TEMPLATES]
    for k in range(400):
        name, words = r.choice(notices)
        changed = list(words)
        if len(words) >= 40:
            changed[r.randrange(len(words))] = "otherword"
        texts.append(" ".join([*(f"x{r.random()}".replace(".", "") for _ in range(r.randint(0, 9))), *changed, *(f"y{r.random()}".replace(".", "") for _ in range(r.randint(0, 9)))]))
        need = {tuple(words[j : j + 5]) for j in range(len(words) - 4)}
        have = {tuple(changed[j : j + 5]) for j in range(len(changed) - 4)}
        if len(need & have) >= 0.8 * len(need):
            want.add((k, name))
    got = {(x.doc_id, x.license_id) for x in license_scan.scan(frame(spark, texts)).collect()}
    assert len(want & got) >= 0.98 * len(want)


def test_license_scan_is_native(spark):
    plan = license_scan.scan(frame(spark, ["Released under the MIT License."]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 8: quality rules

def brute_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed


def test_quality_rules_base_counts_and_fences(spark):
    r = random.Random(14)
    good = sample(15, 80, letters="abcdefghijklmnopqrst", most=10)
    good = [" ".join(g for g in r.sample(good, 30)) for _ in range(80)]
    junk = [" ".join(w + "***" for w in g.split()) for g in good[:4]] + [" | ".join(g.split()) for g in good[4:8]]
    texts = ODD + good + junk + ["a b c a b c a b c " * 30, "line\nline\n line\n" * 20]
    ids = [None, *range(1, len(texts))]
    rows = quality_rules.quality_rules(frame(spark, texts, ids, {5: None, 6: "xx"}))
    got = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert Counter(tuple(x)[:7] for x in got) == Counter((i, *brute_counts(t)) for i, t in zip(ids, texts))
    kept = {x.doc_id for x in got if x.kept}
    first = len(ODD)
    assert not kept & set(range(first + 80, len(texts)))
    assert all(i in kept for i, t in zip(ids, texts) if first <= (i or 0) < first + 80 and not brute_counts(t)[-1])
    assert quality_rules.quality_rules(frame(spark, ["a"]).filter("doc_id < 0")).count() == 0
    assert not re.search("Python|Pandas|Arrow", rows._jdf.queryExecution().toString())


# --- 4: Kneser-Ney

def brute_model(words, order):
    """Probability of a character after a context, from the definition."""
    counts = {order: Counter()}
    for w, n in words.items():
        marked = kneser_ney.START * (order - 1) + w + kneser_ney.END
        for i in range(len(w) + 1):
            counts[order][marked[i : i + order]] += n
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d = {}
    for k, c in counts.items():
        n = Counter(c.values())
        n = [max(n[j], 1) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        d[k] = [max(0.1 * j, min(0.95 * j, j - (j + 1) * y * n[j] / n[j - 1])) for j in (1, 2, 3)]

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        of = [c for g, c in counts[k].items() if g[:-1] == gram[:-1]]
        if not of:
            return p(gram[1:])
        c = counts[k][gram]
        own = max(c - d[k][min(c, 3) - 1], 0) / sum(of) if c else 0
        return own + sum(d[k][min(x, 3) - 1] for x in of) / sum(of) * p(gram[1:])

    return p


def test_a_higher_order_of_the_model_makes_no_larger_plan(spark, capsys):
    joins = []
    for order in (3, 5):
        counts = spark.createDataFrame([("en", kneser_ney.START * (order - 1) + "a", 3), ("en", "abcde"[:order], 1), ("de", "bcdef"[:order], 2)], "lang string, gram string, n long")
        model = kneser_ney.model(counts, order)
        assert model.filter("gram = 'a' and lang = 'en'").count() == 1
        capsys.readouterr()
        model.explain(extended=True)
        joins.append(capsys.readouterr().out.split("== Physical Plan ==")[0].split("== Optimized Logical Plan ==")[1].count("Join "))
    assert joins[0] == joins[1] == 1  # the orders below are read, not planned again under each higher one


def test_kneser_ney_probabilities_and_both_ways_of_scoring(spark):
    texts = sample(16, 25, letters="abc", most=15) + [None, "", "ab ab ab zz"]
    docs = kneser_ney.texts_of(frame(spark, texts + texts[:2], [*range(len(texts)), 0, None]))
    order = 3
    trusted = docs.filter("doc_id < 20")
    entries = kneser_ney.model(kneser_ney.ngram_counts(trusted, order), order).cache()
    words = Counter(w for t in [*texts[:20], texts[0]] for w in WORDS.findall(t or ""))
    p = brute_model(words, order)
    for x in entries.filter("k > 0 and logp is not null").collect():
        assert abs(np.exp(x.logp) - p(x.gram)) < 1e-9, x
    one = kneser_ney.scores_by_broadcast(docs, entries, order).collect()
    two = kneser_ney.scores_by_join(docs, entries, order).collect()
    key = lambda x: (str(x.doc_id), x.text_hash)
    assert len(one) == len(two) == len(texts) + 2
    for x, y in zip(sorted(one, key=key), sorted(two, key=key)):
        assert key(x) == key(y) and x.n_words == y.n_words and (x.mean is None) == (y.mean is None)
        if x.mean is not None:
            assert abs(x.mean - y.mean) < 1e-9 and abs(x.tail - y.tail) < 1e-9
            found = WORDS.findall(texts[x.doc_id] if x.doc_id is not None else texts[1])
            loss = [-sum(np.log(p((kneser_ney.START * (order - 1) + w + kneser_ney.END)[i : i + order])) for i in range(len(w) + 1)) for w in found]
            assert abs(x.mean - sum(loss) / sum(len(w) + 1 for w in found)) < 1e-9


def test_model_rows_are_found_by_their_hash():
    r = np.random.default_rng(5)
    for n in (1, 2, 7, 5000):
        keys = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(n % 2))
        if n == 7:
            keys = np.array([0, 1, 2, 3, (1 << 64) - 3, (1 << 64) - 2, (1 << 64) - 1], np.uint64)  # all in the first and the last place
        entries = kneser_ney.Entries(keys, np.arange(len(keys), dtype=float), np.zeros(len(keys)))
        asked = np.concatenate([keys, keys + np.uint64(1), keys - np.uint64(1), r.integers(0, 1 << 63, 50, dtype=np.uint64)])
        at, there = entries.find(asked)
        assert there.tolist() == np.isin(asked, keys).tolist() and (entries.keys[at[there]] == asked[there]).all()


def test_scores_outlive_a_generation_of_words():
    r = random.Random(6)
    words = ["".join(r.choices("abcde", k=r.randint(1, 5))) for _ in range(300)]
    grams = sorted({g for w in words[:200] for m in [kneser_ney.START * 2 + w + kneser_ney.END] for i in range(len(w) + 1) for k in range(4) for g in [m[max(0, i + 3 - k) : i + 3]]})
    keys = kneser_ney.gram_hashes(grams)
    rng = np.random.default_rng(7)
    entries, toxic = (kneser_ney.Entries(keys, -rng.random(len(keys)) * 9, -rng.random(len(keys))) for _ in range(2))

    def scores(forget_after):
        table, found = kneser_ney.WordScores(entries, 3, None, toxic), []
        for i in range(0, 300, 10):
            texts = [r2.choices(words[max(0, i - 60) : i + 10], k=12) for r2 in [random.Random(i)] for _ in range(5)]
            ids = [table.ids(t) for t in texts]
            table.learn()
            found += [table.of_text(x) for x in ids]
            if len(table) >= forget_after:
                table.forget()
        return found

    assert scores(1) == scores(40) == scores(10**6)


def test_classifier_rejects_foreign_words_and_keeps_clean(spark):
    r = random.Random(17)
    syllables = ["the", "an", "re", "er", "on", "in", "ed", "nd", "ha", "at", "es", "or", "ti", "st"]
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    clean = [" ".join(word() for _ in range(120)) for _ in range(80)]
    foul = [" ".join(word() if j % 20 else r.choice(["qwxzk", "vbpqj", "zzgkx"]) for j in range(120)) for _ in range(10)]
    other = [" ".join("".join(r.choices("kqxzvw", k=5)) for _ in range(60)) for _ in range(10)]
    texts = clean + foul + other + [None, "", "la"]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(80, 1, 1), (90, 0, 0), (None, 1, 0), (81, None, None), (80, 1, 0)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x.kept for x in kneser_ney.classify(frame(spark, texts, langs={102: "xx"}), labels).collect()}
    assert sum(got[i] for i in range(80)) >= 76
    assert not any(got[i] for i in range(80, 100))
    assert got[100] and got[101] and got[102]
    kept = kneser_ney.keep_accepted(frame(spark, texts, langs={102: "xx"}), labels)
    assert {x.doc_id for x in kept.collect()} == {i for i, k in got.items() if k} and kept.columns == frame(spark, []).columns
    empty = frame(spark, ["a"]).filter("doc_id < 0")
    assert kneser_ney.classify(empty, labels).count() == 0
    assert all(x.kept for x in kneser_ney.classify(frame(spark, texts[:3]), labels.filter("quality > 5")).collect())


def test_classifier_rejects_repeated_and_shuffled_words(spark):
    r = random.Random(23)
    syllables = ["the", "an", "re", "er", "on", "in", "ed", "nd", "ha", "at", "es", "or", "ti", "st"]
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    sentence = lambda: " ".join(word() for _ in range(r.randint(5, 9))).capitalize() + "."
    clean = [" ".join(sentence() for _ in range(18)) for _ in range(100)]
    again = [" ".join(w for w in clean[80 + i].split()[:8] for _ in range(15)) for i in range(10)]
    shuffled = [" ".join(r.sample(t.split(), len(t.split()))) for t in clean[85:95]]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    docs = frame(spark, clean + again + shuffled)
    got = {x.doc_id: x.kept for x in kneser_ney.classify(docs, labels).collect()}
    assert sum(got[i] for i in range(100)) >= 90
    assert not any(got[i] for i in range(100, 120))
    joined = {x.doc_id: x for x in kneser_ney.classify(docs, labels, most_entries=0).collect()}
    assert {i: x.kept for i, x in joined.items()} == got


def test_classifier_rejects_toxic_words_made_like_others(spark):
    r = random.Random(29)
    syllables = {"en": ["the", "an", "re", "er", "on", "in", "ed", "nd", "ha", "at"], "es": ["que", "la", "do", "ra", "mente", "co", "bo", "es", "ta", "ue"]}
    texts, langs, quality, new = [], {}, [], []
    for lang, parts in syllables.items():
        word = lambda: "".join(r.choices(parts, k=r.randint(1, 4)))
        clean = lambda: [w for w in (word() for _ in range(160)) if not w.startswith(parts[6] + parts[4])][:120]
        foul = lambda: [w if r.random() > 0.06 else parts[6] + parts[4] + word() for w in clean()]
        for k, toxic in [*((k, 0) for k in range(80)), *((k, 1) for k in range(40))]:
            langs[len(texts)] = lang
            if k < (60 if not toxic else 25):
                quality.append((len(texts), 1, toxic))
            else:
                new.append((len(texts), toxic))
            texts.append(" ".join(foul() if toxic else clean()))
    labels = spark.createDataFrame(quality, "doc_id long, quality int, toxic int")
    docs = frame(spark, texts, langs=langs)
    got = {x.doc_id: x for x in kneser_ney.classify(docs, labels).collect()}
    for lang in syllables:
        assert sum(got[i].kept for i, toxic in new if toxic and langs[i] == lang) <= 1
        assert sum(got[i].kept for i, toxic in new if not toxic and langs[i] == lang) >= 16
    for x in kneser_ney.classify(docs, labels, most_entries=0).collect():
        assert abs(x.toxicity - got[x.doc_id].toxicity) < 1e-9 and abs(x.turn_perplexity - got[x.doc_id].turn_perplexity) < 1e-9


def test_models_that_are_too_large_together_are_broadcast_in_turn(spark, monkeypatch):
    r = random.Random(37)
    syllables = {"en": ["the", "an", "re", "er", "on", "in"], "es": ["que", "la", "do", "ra", "mente", "co"], "de": ["sch", "ei"], "xx": ["q", "z"]}
    texts, langs = [None, ""], {0: "en", 1: "xx"}
    for lang, parts in syllables.items():
        for _ in range(30):
            langs[len(texts)] = lang
            texts.append(" ".join("".join(r.choices(parts, k=r.randint(1, 4))) for _ in range(60)))
    docs = frame(spark, texts, langs=langs)
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in langs if langs[i] != "xx"], "doc_id long, quality int, toxic int")
    sizes, sent = {}, []
    passes, broadcast_model, by_join = kneser_ney.passes, kneser_ney.broadcast_model, kneser_ney.scores_by_join
    monkeypatch.setattr(kneser_ney, "passes", lambda of, most: sizes.update(of) or passes(of, most))
    monkeypatch.setattr(kneser_ney, "broadcast_model", lambda entries: sent.append(entries.count()) or broadcast_model(entries))
    monkeypatch.setattr(kneser_ney, "scores_by_join", lambda *a: pytest.fail("no model is too large by itself"))
    once = {x.doc_id: x for x in kneser_ney.classify(docs, labels).collect()}
    assert set(sizes) == {h + lang for h in "01" for lang in ("de", "en", "es")} and sent == [sum(sizes.values())]
    most = max(sizes.values())
    sent.clear()
    assert {x.doc_id: x for x in kneser_ney.classify(docs, labels, most_entries=most).collect()} == once
    assert len(sent) > 1 and max(sent) <= most and sum(sent) == sum(sizes.values())
    # The largest is now too large by itself, the others are not.
    joined = []
    monkeypatch.setattr(kneser_ney, "scores_by_join", lambda texts, entries, order: joined.append(entries.count()) or by_join(texts, entries, order))
    sent.clear()
    for x in kneser_ney.classify(docs, labels, most_entries=most - 1).collect():
        assert x.kept == once[x.doc_id].kept and x.n_words == once[x.doc_id].n_words and x.trusted == once[x.doc_id].trusted
        for a, b in zip(x, once[x.doc_id]):
            assert a == b or abs(a - b) < 1e-9 * abs(b)
    assert joined and set(joined) == {most} and sum(joined) + sum(sent) == sum(sizes.values())


def test_passes_take_every_model_once():
    sizes = {"0a": 5, "1a": 4, "0b": 3, "1b": 2, "0c": 9, "1c": 1}
    found, alone = kneser_ney.passes(sizes, 7)
    assert alone == ["0c"] and found == [["0a", "1b"], ["1a", "0b"], ["1c"]]
    assert kneser_ney.passes(sizes, 100) == ([["0c", "0a", "1a", "0b", "1b", "1c"]], []) and kneser_ney.passes({}, 7) == ([], [])


def test_a_written_table_takes_its_shuffle_files_along(spark):
    shuffles = lambda: {p for d, _, names in os.walk(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getParent()) for p in names if p.startswith("shuffle_")}
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffles()
    assert cut(rows, "t").count() == 7
    left = shuffles() - before
    assert left
    assert cut(rows, "t", free=True).count() == 7
    assert len(shuffles() - before - left) < len(left) and spark.conf.get(CLEANUP, None) in (None, "false")


def test_classifier_judges_a_language_with_one_trusted_text(spark):
    r = random.Random(31)
    word = lambda letters: "".join(r.choices(letters, k=r.randint(1, 6)))
    texts = [" ".join(word("abcdefgh") for _ in range(300)), *(" ".join(word("qwxzkv") for _ in range(100)) for _ in range(8))]
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in kneser_ney.classify(frame(spark, texts), labels).collect()}
    assert got[0].kept and got[0].max_perplexity is not None
    assert not any(got[i].kept for i in range(1, 9))


# --- 1: HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/b>About</a></ul></nav>
<div id="cookie-notice">We use cookies, and this long notice says so at some length, again and again.</div>
<div class="sidebar"><p>Something beside the page that nobody reads in full.</p></div><div class="ad">Buy now!</div>
%s
<form><label>Mail</label><input name=q><button>Go</button></form><footer>&copy; 2020</footer></body></html>"""
BODY = """<h1>A   title</h1><p>First paragraph &amp; more,<br>with text\n that is long enough.<p>Ti.</p><blockquote>A quote &lt;here&gt;</blockquote>
<ul><li>One<li>Two</ul><!-- ad --><aside>Aside</aside><p>The last paragraph of them all&hellip;</p><section class="comments"><p>I liked it, says a reader at length.</p></section>"""
TEXT = "A title\nFirst paragraph & more, with text that is long enough.\nTi.\nA quote <here>\nOne\nTwo\nThe last paragraph of them all…"


@pytest.mark.parametrize("body", [f"<article>{BODY}</article>", f"<main>{BODY}</main>", f'<div class="post-content">{BODY}</div>'])
def test_main_text(body):
    assert html_extract.main_text(PAGE % body) == TEXT


def test_extract_odd_pages(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "just text"), (None, "u", "<p>a<p>b"), (5, "u", "<div>unclosed <b>bold"), (6, "u", "</p></div>x"), (7, "u", "<nav>menu</nav>"),
             (8, "u", "<article><p>" + "long words " * 50_000 + "</article>"), (3, "u", "just text")]
    rows = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string")
    got = html_extract.extract(rows).collect()
    want = Counter([(1, "u", ""), (2, None, ""), (3, "u", "just text"), (3, "u", "just text"), (None, "u", "a\nb"), (5, "u", "unclosed bold"), (6, "u", "x"), (7, "u", ""),
                    (8, "u", ("long words " * 50_000).strip())])
    assert Counter((x.page_id, x.url, x.text) for x in got) == want
    assert all(x.n_chars == len(x.text) for x in got)
    assert html_extract.extract(rows.filter("page_id < 0")).count() == 0
