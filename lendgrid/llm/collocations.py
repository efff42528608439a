"""Phrase collocation mining by dynamic itemset counting.

The texts are dealt into shards that are scanned in cycles. Words are counted from the
first scan on. A longer phrase becomes active as soon as the phrases without its last and
without its first word have both reached the threshold in what was scanned so far, even
in the middle of a cycle; it is counted from the next scan on until it has seen every
shard once. So lengths are interleaved: while late words still add up, phrases of early ones are
counted in the same scan.

What is active follows from one Bloom filter a length, of fixed size, that holds the
phrases at the threshold. A scan gets the filters as they are now and as they were when
its shard was last scanned: it counts what is active now and was not then. Filters only
gain bits, so every phrase is counted once in every shard, and a false hit of a filter merely
counts a phrase too many. Counters are Spark aggregates by a 64-bit hash; hashes that
collide can only make a count too large. The phrases that reach the threshold in their
counters are then counted again by their text, in one scan that all lengths share, which makes
the result exact.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import byte_words
from .common import cut, scratch_path, ship_package

#: Shards of a cycle.
SHARDS = 2
#: Bits of the filter of one length, and how they are found in a hash: its lowest and its highest ones.
BLOOM_BITS = 1 << 24
#: Bytes of text taken as one slice; its words need some twelve times as much while they are counted.
SLICE_BYTES = 8 << 20
#: Lists of the best phrases that are ranked apart before they are merged.
RANK_PARTS = 64
#: Rows that a task emits at a time.
BATCH_ROWS = 1 << 17
#: Factor of a second hash, which tells apart phrases whose keys collide within a slice.
SECOND = 0xC2B2AE3D27D4EB4F
SPACE, BREAK = 0x20, 0x0A


def _byte(b: int) -> int:
    if b in b".,;:!?\n\x0b\x0c\r":
        return BREAK
    return SPACE if b in b"\x20\t" else b + 0x20 if 0x41 <= b <= 0x5A else b


#: A byte as it is read: BREAK between pieces, SPACE between words, A-Z lower-cased.
READ_BYTES = np.array([_byte(b) for b in range(256)], np.uint8)


class Words:
    """The words of some texts: their spans, keys by language, and whether the next word is in the same piece."""

    def __init__(self, texts: pa.Array, langs: list[str], factor: int = 0x9E3779B97F4A7C15):
        self.buffer, self.first = byte_words.joined(texts, READ_BYTES)
        self.starts, self.lengths = byte_words.spans((self.buffer != SPACE) & (self.buffer != BREAK))
        piece = np.searchsorted(np.flatnonzero(self.buffer == BREAK).astype(np.int32), self.starts)
        self.follows = np.zeros(len(piece), bool)
        self.follows[:-1] = piece[1:] == piece[:-1]
        self.n_words = np.diff(np.append(np.searchsorted(self.starts, self.first), len(self.starts)))
        self.langs = langs
        self.keys = self.keyed(factor)

    def keyed(self, factor: int) -> np.ndarray:
        """A 64-bit key of each word and its language."""
        seeds = {lang: int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for lang in set(self.langs)}
        own = np.repeat(np.array([seeds[lang] for lang in self.langs], np.uint64), self.n_words)
        return byte_words.mix(byte_words.hashes(self.buffer, self.starts, self.lengths, factor) + own, factor)

    def phrases(self, at: np.ndarray, k: int) -> pa.StringArray:
        """The phrases of ``k`` words that begin at the words ``at``, joined by single spaces."""
        words = (at[:, None] + np.arange(k)).ravel()
        lengths = self.lengths[words]
        lengths[np.arange(len(words)) % k < k - 1] += 1  # behind a word that is not the last of its phrase stands a space
        return byte_words.strings(self.buffer, self.starts[words], lengths, joined=k)

    def lang_at(self, at: np.ndarray) -> list[str]:
        return [self.langs[i] for i in np.searchsorted(self.first, self.starts[at], side="right") - 1]


def longer(prefix: np.ndarray, last: np.ndarray, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """The key of a phrase from that of its beginning and that of its last word."""
    return byte_words.mix(prefix * np.uint64(0xD6E8FEB86659FD93) ^ last, factor)


class Filters:
    """A Bloom filter for each length up to ``longest``."""

    def __init__(self, longest: int, packed: bytes | None = None):
        self.bits = np.zeros((longest, BLOOM_BITS // 8), np.uint8) if packed is None else np.frombuffer(zlib.decompress(packed), np.uint8).reshape(longest, -1)

    @staticmethod
    def pack(bits: np.ndarray | None) -> bytes | None:
        """As it travels to the tasks: filters that are nearly empty, or still equal to those before, get small."""
        return None if bits is None else zlib.compress(bits.tobytes(), 1)

    def has(self, k: int, keys: np.ndarray) -> np.ndarray:
        bits, size = self.bits[k - 1], self.bits.shape[1] * 8
        found = np.ones(len(keys), bool)
        for at in ((keys & np.uint64(size - 1)), keys >> np.uint64(64 - (size.bit_length() - 1))):
            at = at.astype(np.int64)
            found &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found

    def add(self, reached: DataFrame) -> None:
        """The keys of ``reached`` (k, key): at most BLOOM_BITS / 64 numbers a length come back."""
        high = 64 - (BLOOM_BITS.bit_length() - 1)
        both = F.array(F.expr(f"key & {BLOOM_BITS - 1}L"), F.expr(f"shiftrightunsigned(key, {high})"))
        words = (reached.select("k", F.explode(both).alias("bit")).groupBy("k", F.shiftright("bit", 6).alias("word"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow())
        k, word, bits = (words.column(c).to_numpy() for c in ("k", "word", "bits"))
        self.bits.view(np.int64)[k.astype(np.int64) - 1, word] |= bits


def active_phrases(words: Words, now: Filters, before: Filters | None, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(k, places, keys, whether the phrase was active before) of all active phrases of 2 to ``longest`` words."""

    def pairs(filters: Filters | None, active: np.ndarray) -> np.ndarray:
        """Where two active phrases at the threshold begin one word apart in a piece."""
        reached = np.zeros(len(active), bool)
        if filters is not None:
            at = np.flatnonzero(active)
            reached[at] = filters.has(k - 1, keys[at])
            reached[:-1] &= reached[1:]
        return reached & words.follows

    keys = words.keys.copy()
    active = was = np.ones(len(keys), bool)
    for k in range(2, longest + 1):
        active, was = pairs(now, active), pairs(before, was)
        at = np.flatnonzero(active)
        keys[at] = longer(keys[at], words.keys[at + k - 1])
        yield k, at, keys[at], was[at]


def _sliced(batch: pa.RecordBatch) -> Iterator[Words]:
    texts = batch.column(1)
    for a, b in byte_words.row_slices(texts, SLICE_BYTES):
        yield Words(texts.slice(a, b - a), batch.column(0).slice(a, b - a).to_pylist())


def count_scan(shard: DataFrame, filters: Broadcast, longest: int, lengths: list[int]) -> DataFrame:
    """(k, key, n): the phrases of a shard that are active by the filters now and were not by those before, slice by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_now, of_before = (None if packed is None else Filters(longest, packed) for packed in filters.value)

        def rows(k: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(keys, return_counts=True)
            for a in range(0, len(keys), BATCH_ROWS):
                some = slice(a, a + BATCH_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys[some]), k, np.int32)), pa.array(keys[some].view(np.int64)), pa.array(n[some])], ["k", "key", "n"])

        for batch in batches:
            for words in _sliced(batch):
                if 1 in lengths:
                    yield from rows(1, words.keys)
                for k, _, keys, was in active_phrases(words, of_now, of_before, max(lengths)):
                    if k in lengths:
                        yield from rows(k, keys[~was])

    return shard.mapInArrow(run, "k int, key long, n long")


def exact_scan(texts: DataFrame, filters: Broadcast, longest: int) -> DataFrame:
    """(lang, k, phrase, n): of the phrases in the filters the exact counts, slice by slice; with
    k = 0 the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filters(longest, filters.value)

        def rows(words: Words, second: np.ndarray, k: int, at: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
            inside = known.has(k, keys)
            at, keys = at[inside], keys[inside]
            others = second[at]
            for i in range(1, k):
                others = longer(others, second[at + i], SECOND)
            order = np.argsort(keys, kind="stable")
            new = keys[order][1:] != keys[order][:-1]
            if (others[order][1:] != others[order][:-1])[~new].any():  # phrases that share a key
                order = np.lexsort((others, keys))
                new = (keys[order][1:] != keys[order][:-1]) | (others[order][1:] != others[order][:-1])
            first = np.flatnonzero(np.concatenate([[True], new])) if len(at) else np.zeros(0, np.int64)
            n, at = np.diff(np.append(first, len(order))), at[order[first]]
            for a in range(0, len(at), BATCH_ROWS):
                some = at[a : a + BATCH_ROWS]
                yield pa.RecordBatch.from_arrays([pa.array(words.lang_at(some), pa.string()), pa.array(np.full(len(some), k, np.int32)), words.phrases(some, k), pa.array(n[a : a + BATCH_ROWS])],
                                                 ["lang", "k", "phrase", "n"])

        for batch in batches:
            for words in _sliced(batch):
                langs = sorted(set(words.langs))
                total = [sum(n for lang, n in zip(words.langs, words.n_words.tolist()) if lang == own) for own in langs]
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array([0] * len(langs), pa.int32()), pa.array([""] * len(langs)), pa.array(total, pa.int64())], ["lang", "k", "phrase", "n"])
                second = words.keyed(SECOND)
                yield from rows(words, second, 1, np.arange(len(words.keys)), words.keys)
                for k, at, keys, _ in active_phrases(words, known, None, longest):
                    yield from rows(words, second, k, at, keys)

    return texts.mapInArrow(run, "lang string, k int, phrase string, n long")


def frequent_phrases(docs: DataFrame, least: int, longest: int, shards: int) -> DataFrame:
    """(lang, k, phrase, n) of all phrases of 1 to ``longest`` words that occur ``least`` times in
    their language, exact; with k = 0 each language's number of words."""
    spark = docs.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "phrase-shards")
    (docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
     .withColumn("shard", (F.monotonically_increasing_id() % shards).cast("int")).write.partitionBy("shard").parquet(path))
    dealt = spark.read.schema("lang string, text binary, shard int").parquet(path)

    filters, history, totals = Filters(longest), [], {}
    step = quiet = 0
    while quiet < shards:
        now = filters.bits.copy()
        before = history[step - shards] if step >= shards else None
        # A length has something to count if it can be active at all and any filter below it has gained bits.
        changed = [now[j].any() if before is None else (now[j] != before[j]).any() for j in range(longest - 1)]
        lengths = ([1] if step < shards else []) + [k for k in range(2, longest + 1) if now[k - 2].any() and any(changed[: k - 1])]
        history.append(now)
        if step >= shards:
            history[step - shards] = None
        if lengths:
            quiet = 0
            shared = spark.sparkContext.broadcast((Filters.pack(now), Filters.pack(before)))
            rows = count_scan(dealt.filter(F.col("shard") == step % shards).select("lang", "text"), shared, longest, lengths)
            for k in lengths:
                rows = rows.union(totals[k]) if k in totals else rows
            # A row a slice and phrase at most: dealt as they are, since one task seldom has two rows to add up.
            summed = rows.repartition("key").groupBy("k", "key").agg(F.sum("n").alias("n"))
            # A length that every shard was scanned for with the filters below it as they are now is complete.
            complete = [k for k in lengths if (k == 1 and step == shards - 1) or (k > 1 and step >= shards - 1 and (now[: k - 1] == history[step - shards + 1][: k - 1]).all())]
            summed = cut(summed.filter((F.col("n") >= least) | ~F.col("k").isin(complete)) if complete else summed, "phrase-counts")
            shared.destroy()  # the written counts need no scan again
            totals |= {k: summed.filter(F.col("k") == k) for k in lengths}
            filters.add(summed.filter(F.col("n") >= least))
        else:
            quiet += 1
        step += 1
    exact = exact_scan(dealt.select("lang", "text"), spark.sparkContext.broadcast(Filters.pack(filters.bits)), longest)
    return exact.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("k") == 0))


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, share: int = 80, top: int = 2000, shards: int = SHARDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``longest`` words of each
    language by score, then occurrences ``a``, both falling, then the phrase in UTF-8.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and those into words at spaces
    and tabs. A phrase occurs ``least`` times at least, overlaps included, within pieces. Cut after its first
    words it has l = occurrences of the beginning, r = of the rest and floor(2000000 a / (l + r)); the lowest cut
    counts, of ties the shortest beginning. A phrase inside a longer one with ``share`` percent of its
    occurrences is left out. ``n`` is the language's number of words.

    A null text is empty, a null lang is ``und`` (as one that is called so); every row counts, a repeated one
    again; a text of any length is taken whole, as a slice of its own; an empty table gives an empty one; columns
    other than text and lang are not read.
    """
    phrases = cut(frequent_phrases(docs, least, longest, shards), "phrases")
    words = F.split("phrase", " ")
    known = phrases.filter("k > 0")
    longer_ones = known.filter("k > 1").withColumn("words", words)

    def part(begin: str, size: str) -> Column:
        return F.expr(f"array_join(slice(words, {begin}, {size}), ' ')")

    cuts = (longer_ones.select("lang", "phrase", "k", F.col("n").alias("a"), "words", F.explode(F.expr("sequence(1, k - 1)")).alias("first"))
            .select("lang", "phrase", "a", "first", part("1", "first").alias("left"), part("first + 1", "k - first").alias("right")))
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    # Exact: products may pass 64 bits.
    score = F.expr("cast(2000000 as decimal(10, 0)) * cast(a as decimal(20, 0)) div cast(l + r as decimal(20, 0))")
    lowest = (cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "first", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    inner = (longer_ones.filter("k > 2").select("lang", "words", "k", "n", F.explode(F.expr("sequence(2, k - 1)")).alias("size"))
             .select("lang", "words", "n", "size", F.explode(F.expr("sequence(1, k - size + 1)")).alias("begin"))
             .groupBy("lang", part("begin", "size").alias("phrase")).agg(F.max("n").alias("longer_n")))
    kept = (lowest.join(inner, ["lang", "phrase"], "left")
            .filter(F.expr(f"longer_n is null or cast(100 as decimal(10, 0)) * longer_n < cast({share} as decimal(10, 0)) * a")).drop("longer_n"))
    # The best of each part of a language first, so that no task has a whole language.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    best = (kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = phrases.filter("k = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
